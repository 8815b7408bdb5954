"""Request planning: retrieval plan, colour inference, plan trace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions import fixed
from vitrine.functions.text import strip_ws, word_count, ws_tokens


def plan_requests(requests: DataFrame) -> DataFrame:
    """Adds ``retrieval_strategy``, ``planned_top_k`` (2 to 5) and ``keywords``.

    Three or more name words call for hybrid retrieval, else dense. Each of: a colour, a category, a long
    name adds one to a top-k of 2. Keywords are the distinct lower-case name and colour words.
    """
    long_name = word_count(F.col("name")) >= 3
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0)
    words = ws_tokens(F.lower(F.concat_ws(" ", F.col("name"), F.col("color"))))
    return requests.withColumns(
        {
            "retrieval_strategy": F.when(long_name, "hybrid").otherwise("dense"),
            "planned_top_k": F.lit(2) + filled("color") + filled("category")
            + F.when(long_name, 1).otherwise(0),
            "keywords": F.array_distinct(words),
        }
    )


def enrich_color(requests: DataFrame) -> DataFrame:
    """A blank colour takes the whole colour text of the best hit.

    Expects ``similar`` (ranked array of hits). Adds ``final_color``, ``enrich_status`` and
    ``enrich_detail``.
    """
    color = F.coalesce(F.col("color"), F.lit(""))
    none_found = F.coalesce(F.size("similar"), F.lit(0)) == 0
    best = strip_ws(F.coalesce(F.try_element_at("similar", F.lit(1))["colors_extracted"], F.lit("")))
    final = F.when((color != "") | none_found, color).otherwise(best)
    status = (
        F.when((color != "") | none_found, "skipped").when(best != "", "ok").otherwise("warn")
    )
    detail = (
        F.when(color != "", F.format_string("color already provided: '%s'", color))
        .when(none_found, fixed.NOTHING_TO_INFER_FROM)
        .when(best != "", F.format_string("inferred color='%s' from top retrieved product", best))
        .otherwise(fixed.NO_COLOR_DATA)
    )
    return requests.withColumns(
        {"final_color": final, "enrich_status": status, "enrich_detail": detail}
    )


def plan_trace(retrieval: bool = True) -> Column:
    """Array of the four steps ``struct<name, status, detail>`` of an enriched, generated request."""
    shown = F.when(F.col("color") == "", "(empty)").otherwise(F.col("color"))
    parse = F.format_string("name='%s'  color='%s'", F.col("name"), shown)
    hits = F.coalesce(F.size("similar"), F.lit(0))
    if retrieval:
        top = F.try_element_at("similar", F.lit(1))["similarity_score"]
        found = F.when(
            # format_number rounds the exact binary value, as C and Python do; %.3f in Java does not
            hits > 0,
            F.format_string(
                "found %d products  (top score: %s)",
                hits,
                F.call_function("format_number", top, F.lit("0.000")),  # no thousands separator
            ),
        ).otherwise(fixed.NO_RESULTS)
        retrieve = ("ok", found)
    else:
        retrieve = ("skipped", F.lit(fixed.RETRIEVAL_OFF))
    written = F.format_string("generated %d tokens", word_count(F.col("description")))
    rows = zip(
        fixed.STEPS,
        [
            (F.lit("ok"), parse),
            (F.lit(retrieve[0]), retrieve[1]),
            (F.col("enrich_status"), F.col("enrich_detail")),
            (F.lit("ok"), written),
        ],
    )
    return F.array(
        *[
            F.struct(F.lit(name).alias("name"), status.alias("status"), detail.alias("detail"))
            for name, (status, detail) in rows
        ]
    )
