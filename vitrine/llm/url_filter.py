"""URL filters: an explicit rule list, and a path-template tree learned per host.

The tree. Every path is split into segments; segments that vary by nature (numbers, hexadecimal strings, ids) become
``*``, and so does a segment under a parent that has nearly as many different children as rows. A node of the tree is
a host with the first segments of a template, as deep as paths go. Nodes hold counts of labelled and of rejected rows. From the
root down, a branch whose share of rejected rows does not differ from that of its siblings together (two-proportion test) is
merged with them; the others keep their own counts.

A template's purity is the share of rejected rows among the labelled rows of its (merged) node, smoothed towards the share of the
same template on other hosts, that one towards the purity of the node's parent, and so on up to the host, which is smoothed
towards all labelled rows. So a host or template without labels is judged by what is known of the template elsewhere, then by its
parent. Templates of at least ``max_purity`` are rejected if the deepest node with labelled rows, here or on other hosts, has
``min_labels`` of them; the others are allowed.

Null and unparsable urls have an empty host and path: the root template of the empty host. Repeated rows count as often
as they occur. An empty table gives no rows. Columns other than the id and ``url`` are not read, so their names may clash. Nodes are
known by 128-bit digests of their segments, so a path of n segments is n narrow rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import stored
from vitrine.operators.joins import salted_join

ALLOW, BLOCK = "allow", "block"
WILD = "*"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def split_rule(rule: str) -> tuple[str, str]:
    """``example.com/en/`` -> host ``example.com`` and path prefix ``/en/``."""
    host, _, path = rule.partition("/")
    return host.lower(), "/" + path


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. A rule fits its host and all subdomains, and paths that start with its own."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        rule_host, rule_path = split_rule(rule)
        fits = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        fits = fits & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, rule) if found is None else found.when(fits, rule)
    return found if found is not None else F.lit(None).cast("string")


def rule_verdict(rule: Column, rules: dict[str, str]) -> Column:
    blocked = [r for r, v in rules.items() if v == BLOCK]
    return F.when(rule.isNull(), None).when(rule.isin(blocked) if blocked else F.lit(False), BLOCK).otherwise(ALLOW)


def segments_of(path: Column) -> Column:
    """Path segments with the ones that vary by nature as wildcards; an extension stays (``12.html`` -> ``*.html``)."""
    variable = r"^(?:\d+|[0-9a-fA-F-]{8,}|[A-Za-z_-]*\d{3,}[A-Za-z0-9_-]*)(\.[A-Za-z]{1,5})?\z"
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(s, variable, WILD + "$1"))


def joined(segments: Column, depth: Column | None = None) -> Column:
    return F.array_join(segments if depth is None else F.slice(segments, 1, depth), "/")


def template_key(host: Column, segments: Column) -> Column:
    return F.md5(F.concat(host, F.lit("/"), joined(segments)))


def template_stats(pages: DataFrame) -> DataFrame:
    """``(host, segments, rows, labelled, rejected)`` per distinct template; ``label`` is 1 for rejected, 0, or null.

    Counting combines on the map side, so a host with any share of the rows is a few partial counts per task.
    """
    return pages.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("label").alias("labelled"),
        F.sum(F.coalesce(F.col("label"), F.lit(0)).cast("bigint")).alias("rejected"),
    )


def exploded(stats: DataFrame) -> DataFrame:
    """One narrow row per template and depth (0 is the host): ``parent`` and ``node`` are digests of the template's prefixes."""
    depths = F.sequence(F.lit(0), F.size("segments"))
    keyed = stats.withColumn("nodes", F.transform(depths, lambda d: F.md5(joined(F.col("segments"), d))))
    level = F.transform(
        depths,
        lambda d: F.struct(
            d.alias("depth"),
            F.get("nodes", d - 1).alias("parent"),
            F.get("nodes", d).alias("node"),
            F.get("segments", d - 1).alias("segment"),
            F.get("original", d - 1).alias("raw"),
        ),
    )
    return keyed.select(
        "host", template_key(F.col("host"), F.col("original")).alias("key"), "rows", "labelled", "rejected", F.inline(level)
    )


def segment_list(levels: str, name: str) -> Column:
    return F.transform(F.filter(levels, lambda x: x["depth"] > 0), lambda x: x[name])


def generalise(stats: DataFrame, max_distinct: float = 0.5, min_rows: int = 20) -> DataFrame:
    """``stats`` with wildcards for segments whose parent has nearly as many different children as rows.

    ``original`` keeps the segments as they were. All levels are judged in one pass.
    """
    levels = exploded(stats.withColumn("original", F.col("segments")))
    varying = (
        levels.where("depth > 0")
        .groupBy("host", "parent", "node")
        .agg(F.sum("rows").alias("rows"))
        .groupBy("host", "parent")
        .agg(F.sum("rows").alias("all_rows"), F.count(F.lit(1)).alias("children"))
        .where((F.col("all_rows") >= min_rows) & (F.col("children") >= max_distinct * F.col("all_rows")))
        .select("host", "parent", F.lit(True).alias("varies"))
    )
    segment = F.when(F.col("varies"), F.lit(WILD)).otherwise(F.col("segment"))
    return (
        levels.join(varying, ["host", "parent"], "left")
        .groupBy("host", "key")
        .agg(
            F.sort_array(F.collect_list(F.struct("depth", segment.alias("segment"), "raw"))).alias("levels"),
            F.first("rows").alias("rows"),
            F.first("labelled").alias("labelled"),
            F.first("rejected").alias("rejected"),
        )
        .select(
            "host", "rows", "labelled", "rejected",
            segment_list("levels", "segment").alias("segments"),
            segment_list("levels", "raw").alias("original"),
        )
    )


def judge_templates(
    stats: DataFrame,
    max_purity: float = 0.7,
    prior_weight: float = 4.0,
    min_labels: int = 5,
    z_merge: float = 1.96,
) -> DataFrame:
    """``(host, segments, template, purity, method_verdict)`` for each distinct template of ``template_stats``."""
    stats = stored(generalise(stats), "url-templates")
    total = stats.agg(F.sum("labelled"), F.sum("rejected")).first()  # two numbers
    prior = ((total[1] or 0) + 0.5) / ((total[0] or 0) + 1)

    levels = exploded(stats)
    nodes = levels.groupBy("host", "parent", "node", "depth").agg(
        F.sum("labelled").cast("double").alias("own_n"), F.sum("rejected").cast("double").alias("own_k")
    )
    # The pool of a branch: all branches under the same parent of the host.
    pools = (
        nodes.where("depth > 0")
        .groupBy("host", "parent")
        .agg(F.sum("own_n").alias("pool_n"), F.sum("own_k").alias("pool_k"))
    )
    everywhere = (
        nodes.where("depth > 0 and own_n > 0")
        .groupBy("node")
        .agg(F.sum("own_n").alias("all_n"), F.sum("own_k").alias("all_k"))
    )
    rest_n, rest_k = F.col("pool_n") - F.col("own_n"), F.col("pool_k") - F.col("own_k")
    share = F.col("pool_k") / F.expr("nullif(pool_n, 0)")
    own_share = F.col("own_k") / F.expr("nullif(own_n, 0)")
    rest_share = rest_k / F.expr("nullif(pool_n - own_n, 0)")
    error = F.sqrt(share * (1 - share) * (1 / F.expr("nullif(own_n, 0)") + 1 / F.expr("nullif(pool_n - own_n, 0)")))
    alike = F.coalesce(F.abs(own_share - rest_share) <= z_merge * error, F.lit(False))
    judged = (
        nodes.join(pools, ["host", "parent"], "left")
        .join(everywhere, "node", "left")
        .select(
            "host",
            "node",
            alike.alias("merged"),
            F.when(alike, F.col("pool_n")).otherwise(F.col("own_n")).alias("n"),
            F.when(alike, F.col("pool_k")).otherwise(F.col("own_k")).alias("k"),
            F.coalesce(F.col("all_n") - F.col("own_n"), F.lit(0.0)).alias("other_n"),
            F.coalesce(F.col("all_k") - F.col("own_k"), F.lit(0.0)).alias("other_k"),
        )
    )

    def below(above: Column, x: Column) -> Column:
        elsewhere = (x["other_k"] + prior_weight * above["purity"]) / (x["other_n"] + prior_weight)
        known = x["n"] + x["other_n"]
        return F.struct(
            ((x["k"] + prior_weight * elsewhere) / (x["n"] + prior_weight)).alias("purity"),
            F.when(known > 0, known).otherwise(above["known"]).alias("known"),
        )

    top = F.struct(F.lit(prior).alias("purity"), F.lit(0.0).alias("known"))
    last = F.element_at("levels", -1)
    template = F.when(
        last["merged"], joined(F.concat(F.slice("general", 1, F.size("general") - 1), F.array(F.lit(WILD))))
    ).otherwise(joined(F.col("general")))
    rejects = (F.col("end.purity") >= max_purity) & (F.col("end.known") >= min_labels)
    fields = ["depth", "segment", "raw", "merged", "n", "k", "other_n", "other_k"]
    return (
        levels.join(judged, ["host", "node"])
        .groupBy("host", "key")
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("levels"))
        .withColumns({"end": F.aggregate("levels", top, below), "general": segment_list("levels", "segment")})
        .select(
            "host",
            segment_list("levels", "raw").alias("segments"),
            template.alias("template"),
            F.col("end.purity").alias("purity"),
            F.when(rejects, BLOCK).otherwise(ALLOW).alias("method_verdict"),
        )
    )


def filter_urls(pages: DataFrame, rules: dict[str, str], id_column: str = "page_id") -> DataFrame:
    """``(id, host, path, rule, template, purity, verdict)`` for every row of ``(id, url)``.

    Rows that a rule decides are the labelled rows of the tree; a rule's verdict stands, the others get the tree's.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    read = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    ruled = read.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    ruled = ruled.withColumn("by_rule", rule_verdict(F.col("rule"), rules)).withColumn(
        "segments", segments_of(F.col("path"))
    )
    label = F.when(F.col("by_rule") == BLOCK, 1).when(F.col("by_rule") == ALLOW, 0)
    verdicts = judge_templates(template_stats(ruled.withColumn("label", label)))
    key = template_key(F.col("host"), F.col("segments")).alias("key")
    keyed = ruled.select("*", key).drop("segments")
    looked_up = verdicts.select(key, "template", "purity", "method_verdict")
    return salted_join(keyed, looked_up, "key", F.col(id_column), "left").select(
        id_column,
        "host",
        "path",
        "rule",
        "template",
        "purity",
        F.coalesce("by_rule", "method_verdict").alias("verdict"),
    )
