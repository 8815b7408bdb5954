"""The registered queries as SQL for DuckDB, built from shared table expressions.

The SQL restates each result independently of the Spark plans: joins and windows over all pairs where
the engine prunes, long form where it uses arrays.
"""

from __future__ import annotations

from vitrine.functions import fixed


# The rules once more, in DuckDB's regular expressions: a wrong rule of the engine must not pass here as well.
_BLANK = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\p{Z}"
_CLEAN_STEPS = [
    (rf"#[\p{{L}}\p{{N}}_-]+[{_BLANK}]*\{{[^}}]*\}}", ""),
    (r"<[^>]+>", ""),
    (rf"(http|www)[^{_BLANK}]+", ""),
    (r"[^\x00-\x7F]", ""),
    (r"[^\x09-\x0D\x1C-\x20A-Za-z0-9.,!?'\x22-]+", " "),
    (r"[\x09-\x0D\x1C-\x20]+", " "),
]
_TOKEN_STEPS = [
    (r"(^|\s)\x22", "$1`` "),
    (r"\x22", " '' "),
    (r"(\.\.+)", " $1 "),
    (r",([^0-9]|$)", " , $1"),
    (r"(\?|!)", " $1 "),
    (r"([^.])\.(\s|$)", "$1 . $2"),
    (r"--", " -- "),
    (r"([^' ])(n't)(\s|$)", "$1 $2$3"),
    (r"([^' ])('s|'m|'d|'ll|'re|'ve)(\s|$)", "$1 $2$3"),
]


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rewrite(x: str, rules: list[tuple[str, str]]) -> str:
    for pattern, replacement in rules:
        for i in range(1, 4):
            replacement = replacement.replace(f"${i}", f"\\{i}")
        x = f"regexp_replace({x}, {_q(pattern)}, {_q(replacement)}, 'g')"
    return x


def _strip(x: str) -> str:
    return _rewrite(x, [(f"^[{_BLANK}]+|[{_BLANK}]+$", "")])


def _clean(x: str) -> str:
    return f"lower(trim({_rewrite(x, _CLEAN_STEPS)}))"


def _treebank(x: str) -> str:
    return rf"regexp_extract_all({_rewrite(x, _TOKEN_STEPS)}, '\S+')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, {_q(f'[^{_BLANK}]+')})"


def _alnum(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9]+')"


def _kept(x: str) -> str:
    stop = ", ".join(_q(w) for w in fixed.LIGHT_STOPWORDS)
    return f"array_to_string(list_filter({_treebank(x)}, lambda t: t NOT IN ({stop})), ' ')"


def _count(x: str) -> str:
    return f"CAST(len({_words(x)}) AS INTEGER)"


def _hash(x: str) -> str:
    return f"CAST(('0x' || substr(md5({x}), 1, 8)) AS BIGINT)"


def _seeded(key: str) -> str:
    return f"'{fixed.SEED}:' || CAST({key} AS VARCHAR)"


def _fill(template: str, **fields: str) -> str:
    sql = _q(template)
    for name, value in fields.items():
        sql = f"replace({sql}, '{{{name}}}', {value})"
    return sql


# --- shared table expressions ------------------------------------------------------------------

_FIRST = "split_part(p_name, ' ', 1)"
_LAST = "split_part(p_name, ' ', 2)"

_CTE = {
    "cat": f"""SELECT doc_id AS row_id, p_name AS name, text AS fulldescription,
        CASE WHEN {_FIRST} IN ('red', 'blue') THEN '[''' || {_FIRST} || ''']' ELSE '[]' END AS colorname
        FROM documents JOIN part ON p_partkey = doc_id""",
    "base": """SELECT row_id, nullif(name, '[]') AS name, nullif(fulldescription, '[]') AS fulldescription,
        coalesce(nullif(colorname, '[]'), 'unknown') AS colorname
        FROM cat WHERE nullif(fulldescription, '[]') IS NOT NULL""",
    "cleaned": f"""SELECT row_id, {_clean(_strip('lower(name)'))} AS name_clean,
        {_kept(_clean('fulldescription'))} AS fulldescription_clean,
        CASE WHEN colorname = 'unknown' THEN 'unknown'
             ELSE regexp_extract(colorname, '[a-z]+') END AS colorname_clean FROM base""",
    "preprocessed": """SELECT * FROM cleaned
        QUALIFY row_number() OVER (PARTITION BY fulldescription_clean ORDER BY row_id) = 1""",
    "features": f"""SELECT row_id, name_clean, fulldescription_clean,
        CASE WHEN colorname_clean = 'unknown' THEN '' ELSE colorname_clean END AS colors_extracted,
        {_count('fulldescription_clean')} AS desc_word_count
        FROM preprocessed WHERE {_count('fulldescription_clean')} >= {fixed.MIN_WORDS}""",
    "prompted": f"""SELECT *, {_count('prompt')} AS prompt_length FROM (SELECT *, {_fill(
        fixed.TRAINING_PROMPT, name='name_clean', color='colors_extracted',
        description='fulldescription_clean')} AS prompt FROM features)""",
    "texts": f"""SELECT *, {_fill(fixed.PRODUCT_TEXT, name='name_clean', color='colors_extracted',
        description='fulldescription_clean')} AS product_text FROM features""",
    "tf": f"""SELECT row_id, {_hash('t')} % {fixed.EMBEDDING_DIM} AS bucket, count(*) AS tf
        FROM (SELECT row_id, unnest({_words('lower(product_text)')}) AS t FROM texts)
        GROUP BY ALL""",
    "idf": f"""SELECT b AS bucket, ln((1 + (SELECT count(*) FROM texts)) / (1 + count(tf.bucket))) + 1 AS idf
        FROM range({fixed.EMBEDDING_DIM}) r(b) LEFT JOIN tf ON tf.bucket = b GROUP BY b""",
    "emb": """SELECT row_id, bucket, CAST(CAST(w / n AS FLOAT) AS DOUBLE) AS weight
        FROM (SELECT row_id, bucket, tf * idf AS w FROM tf JOIN idf USING (bucket))
        JOIN (SELECT row_id, sqrt(sum(tf * idf * (tf * idf) ORDER BY bucket)) AS n
              FROM tf JOIN idf USING (bucket) GROUP BY row_id) USING (row_id)""",
    "req": f"""SELECT p_partkey AS query_id, p_name AS name,
        CASE WHEN {_FIRST} IN ('new', 'old') THEN '' ELSE {_FIRST} END AS color,
        {_LAST} AS category, CAST(ceil(p_size / 10) AS INTEGER) AS top_k FROM part""",
    "planreq": """SELECT query_id, name || CASE WHEN p_type = 'ECONOMY' THEN ' ' || lower(p_type) ELSE '' END AS name,
        color, category FROM req JOIN part ON p_partkey = query_id""",
    "pairs": """SELECT u.conv_id * 1000 + u.turn AS pair_id, u.text AS reference, a.text AS generated
        FROM conversations u JOIN conversations a
        ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "bdoc": f"""SELECT row_id, name_clean, {_words("lower(name_clean || ' ' || colors_extracted)")} AS tokens
        FROM features""",
    "btf": """SELECT row_id, t, count(*) AS tf, dl FROM
        (SELECT row_id, unnest(tokens) AS t, len(tokens) AS dl FROM bdoc) GROUP BY ALL""",
    "bterm": f"""SELECT t, df, CASE WHEN raw < 0 THEN avg(raw) OVER () * {fixed.BM25_EPSILON}::DOUBLE
            ELSE raw END AS idf
        FROM (SELECT t, count(*) AS df,
              ln((SELECT count(*) FROM bdoc) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw
              FROM btf GROUP BY t)""",
    "plan": f"""SELECT *, CASE WHEN {_count('name')} >= 3 THEN 'hybrid' ELSE 'dense' END AS retrieval_strategy,
        2 + CAST(color <> '' AS INTEGER) + CAST(category <> '' AS INTEGER)
          + CAST({_count('name')} >= 3 AS INTEGER) AS planned_top_k FROM planreq""",
    "split": f"""SELECT doc_id AS row_id, text, CASE WHEN {_hash(_seeded('doc_id'))} % 1000 <
        {round(fixed.VALIDATION_SHARE * 1000)} THEN 'val' ELSE 'train' END AS split FROM documents""",
    "vocab": f"""SELECT token, row_number() OVER (ORDER BY count DESC, token) + 1 AS id, count FROM
        (SELECT token, count(*) AS count FROM (SELECT unnest({_words('lower(src)')}) AS token FROM vocab_source)
         GROUP BY token)""",
    "losses": """SELECT event_id AS row_id, CASE event_type WHEN 'error' THEN 'nan'::DOUBLE
        WHEN 'click' THEN 'inf'::DOUBLE ELSE value / 100 END AS loss FROM events""",
}

_NEEDS = {
    "base": ["cat"],
    "cleaned": ["base"],
    "preprocessed": ["cleaned"],
    "features": ["preprocessed"],
    "prompted": ["features"],
    "texts": ["features"],
    "tf": ["texts"],
    "idf": ["tf"],
    "emb": ["idf"],
    "planreq": ["req"],
    "bdoc": ["features"],
    "btf": ["bdoc"],
    "bterm": ["btf"],
    "plan": ["planreq"],
}


def _with(needed: list[str], body: str, *extra: tuple[str, str], recursive: bool = False) -> str:
    """``body`` preceded by the named expressions, what they need, and ``extra`` ones."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for below in _NEEDS.get(name, []):
            add(below)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    parts = [(name, _CTE[name]) for name in ordered] + list(extra)
    # expressions that several others read are computed once
    listed = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in parts)
    if recursive:
        listed = listed.replace("AS MATERIALIZED (WITH_RECURSION ", "AS (")
    return f"WITH {'RECURSIVE ' if recursive else ''}{listed}\n{body}"


_QUERY_TEXT = """CASE WHEN color <> '' THEN 'Product: ' || name || chr(10) || 'Color: ' || color
            ELSE 'Product: ' || name END"""


def _dense(source: str, k: str, qtext: str = _QUERY_TEXT) -> list[tuple[str, str]]:
    """``dhits``: the best k catalogue rows of every request in ``source``."""
    return [
        ("asked", f"SELECT *, {qtext} AS qtext FROM {source}"),
        (
            "qtf",
            f"""SELECT qtext, {_hash('t')} % {fixed.EMBEDDING_DIM} AS bucket, count(*) AS tf FROM
            (SELECT qtext, unnest({_words('lower(qtext)')}) AS t FROM (SELECT DISTINCT qtext FROM asked))
            GROUP BY ALL""",
        ),
        (
            "qemb",
            """SELECT qtext, bucket, CAST(CAST(tf * idf / n AS FLOAT) AS DOUBLE) AS weight
            FROM qtf JOIN idf USING (bucket)
            JOIN (SELECT qtext, sqrt(sum(tf * idf * (tf * idf) ORDER BY bucket)) AS n
                  FROM qtf JOIN idf USING (bucket) GROUP BY qtext) USING (qtext)""",
        ),
        (
            "dtop",
            f"""SELECT qtext, row_id, score,
                row_number() OVER (PARTITION BY qtext ORDER BY score DESC, row_id) AS rank
            FROM (SELECT qtext, row_id, sum(q.weight * e.weight ORDER BY bucket) AS score
                  FROM qemb q JOIN emb e USING (bucket) GROUP BY qtext, row_id)
            QUALIFY rank <= {k}""",
        ),
        (
            "dhits",
            """SELECT asked.*, CAST(rank AS INTEGER) AS rank, row_id, name_clean, colors_extracted,
                fulldescription_clean, round(score, 4) AS similarity_score
            FROM asked JOIN dtop USING (qtext) JOIN features USING (row_id)""",
        ),
    ]


def _keyword(source: str, k: str) -> list[tuple[str, str]]:
    """``khits``: the best k catalogue rows by BM25."""
    gain = (
        f"(tf * {fixed.BM25_K1 + 1}::DOUBLE) / (tf + {fixed.BM25_K1}::DOUBLE * (1 - {fixed.BM25_B}::DOUBLE"
        f" + {fixed.BM25_B}::DOUBLE * dl / (SELECT avg(len(tokens)) FROM bdoc)))"
    )
    return [
        (
            "kasked",
            f"SELECT *, lower(name || ' ' || color) AS ktext FROM {source}",
        ),
        (
            "kterm",
            f"""SELECT ktext, t, count(*) AS times FROM
            (SELECT ktext, unnest({_words('ktext')}) AS t FROM (SELECT DISTINCT ktext FROM kasked)) GROUP BY ALL""",
        ),
        (
            "ktop",
            f"""SELECT ktext, row_id, score,
                row_number() OVER (PARTITION BY ktext ORDER BY score DESC, row_id) AS rank
            FROM (SELECT ktext, row_id, coalesce(score, 0) AS score
                  FROM (SELECT DISTINCT ktext FROM kasked) CROSS JOIN (SELECT row_id FROM bdoc)
                  LEFT JOIN (SELECT ktext, row_id, sum(idf * times * ({gain}) ORDER BY t) AS score
                             FROM kterm JOIN bterm USING (t) JOIN btf USING (t) GROUP BY ktext, row_id)
                  USING (ktext, row_id))
            QUALIFY rank <= {k}""",
        ),
        (
            "khits",
            """SELECT kasked.*, CAST(rank AS INTEGER) AS rank, row_id, name_clean,
                round(score, 4) AS similarity_score
            FROM kasked JOIN ktop USING (ktext) JOIN features USING (row_id)""",
        ),
    ]


def _merged(k: str, fetched: str = "") -> tuple[str, str]:
    """``merged``: dense then keyword hits, one per name, first k; ``fetched`` limits the hits before."""
    return (
        "merged",
        f"""SELECT query_id, row_id, name_clean, source, similarity_score, CAST(place AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY source, rank) AS place
        FROM (SELECT * FROM (
                SELECT query_id, rank, row_id, name_clean, similarity_score, 'dense' AS source FROM dhits {fetched}
                UNION ALL
                SELECT query_id, rank, row_id, name_clean, similarity_score, 'keyword' FROM khits {fetched})
              QUALIFY row_number() OVER (PARTITION BY query_id, name_clean ORDER BY source, rank) = 1))
        WHERE place <= {k}""",
    )


def _fallback(name: str, source: str, col: str, wanted: str) -> tuple[str, str]:
    match = f"contains(lower({col}), lower({wanted}))"
    return (
        name,
        f"""SELECT * FROM {source} QUALIFY {wanted} = '' OR {match}
            OR NOT bool_or({match}) OVER (PARTITION BY query_id)""",
    )


_ASKED = ["features", "emb", "req"]
_HITS = _dense("req", "5") + [("hits", "SELECT * FROM dhits WHERE rank <= top_k")]
_FILTERED = _HITS + [
    _fallback("bycolor", "hits", "colors_extracted", "color"),
    _fallback("filtered", "bycolor", "name_clean", "category"),
]
_HITS3 = _dense("req", "3")
_BEST = ("best", "SELECT query_id, colors_extracted AS best, name_clean, similarity_score FROM dhits WHERE rank = 1")
_ENRICHED = _HITS3 + [
    _BEST,
    (
        "enriched",
        """SELECT query_id, name, color, CASE WHEN color <> '' THEN color ELSE coalesce(best, '') END AS final_color,
            CASE WHEN color <> '' OR best IS NULL THEN 'skipped' WHEN best <> '' THEN 'ok' ELSE 'warn' END
              AS enrich_status,
            CASE WHEN color <> '' THEN 'color already provided: ''' || color || ''''
              WHEN best IS NULL THEN 'no retrieved products to infer from'
              WHEN best <> '' THEN 'inferred color=''' || best || ''' from top retrieved product'
              ELSE 'retrieved product has no color data; continuing without color' END AS enrich_detail,
            name_clean AS top_similar, similarity_score AS top_score,
            (SELECT count(*) FROM dhits h WHERE h.query_id = req.query_id) AS n
        FROM req LEFT JOIN best USING (query_id)""",
    ),
]

_BLEU_TOKENS = (
    "btok",
    f"""SELECT pair_id, {_treebank('lower(reference)')} AS r, {_treebank('lower(generated)')} AS g FROM pairs""",
)


def _grams(source: str, tokens: str, n: int, key: str = "pair_id") -> str:
    parts = " || ' ' || ".join(f"{tokens}[i + {j}]" for j in range(n))
    return f"""SELECT {key}, gram, count(*) AS c FROM (SELECT {key}, {parts} AS gram FROM
        (SELECT {key}, {tokens}, unnest(range(1, len({tokens}) - {n - 2})) AS i FROM {source}))
        GROUP BY ALL"""


def _overlap(source: str, n: int) -> str:
    return f"""SELECT pair_id, sum(least(a.c, b.c)) AS m FROM ({_grams(source, 'r', n)}) a
        JOIN ({_grams(source, 'g', n)}) b USING (pair_id, gram) GROUP BY pair_id"""


_BLEU = [
    _BLEU_TOKENS,
    *[(f"m{n}", f"SELECT coalesce(sum(m), 0) AS m FROM ({_overlap('btok', n)})") for n in range(1, 5)],
    (
        "sums",
        "SELECT CAST(sum(len(r)) AS BIGINT) AS ref_len, CAST(sum(len(g)) AS BIGINT) AS gen_len, "
        + ", ".join(
            f"CAST((SELECT m FROM m{n}) AS BIGINT) AS match_{n}, "
            f"CAST(sum(greatest(1, len(g) - {n - 1})) AS BIGINT) AS total_{n}"
            for n in range(1, 5)
        )
        + " FROM btok",
    ),
]


def _bleu_value(weights: list[float]) -> str:
    terms = " + ".join(
        f"{w}::DOUBLE * ln(CASE WHEN match_{n} = 0 THEN {fixed.BLEU_SMOOTHING}::DOUBLE ELSE match_{n} END / total_{n})"
        for n, w in enumerate(weights, 1)
    )
    return f"""CASE WHEN match_1 = 0 THEN 0 ELSE exp({terms}) *
        CASE WHEN gen_len > ref_len THEN 1 ELSE exp(1 - ref_len / gen_len) END END"""


_ROUGE = [
    ("rtok", f"SELECT pair_id, {_alnum('reference')} AS r, {_alnum('generated')} AS g FROM pairs"),
    ("o1", _overlap("rtok", 1)),
    ("o2", _overlap("rtok", 2)),
    # one row of the alignment table per step: the running maximum over the positions of the reference
    (
        "lcs",
        """WITH_RECURSION SELECT pair_id, 0 AS step, j, 0 AS best FROM
            (SELECT pair_id, unnest(range(0, len(r) + 1)) AS j FROM rtok)
        UNION ALL
        SELECT pair_id, step + 1, j, max(reach) OVER (PARTITION BY pair_id ORDER BY j) FROM (
            SELECT l.pair_id, l.step, l.j, greatest(l.best, CASE WHEN l.j > 0 AND t.r[l.j] = t.g[l.step + 1]
                THEN lag(l.best, 1, 0) OVER (PARTITION BY l.pair_id ORDER BY l.j) + 1 ELSE 0 END) AS reach
            FROM lcs l JOIN rtok t ON t.pair_id = l.pair_id WHERE l.step < len(t.g))""",
    ),
    (
        "ol",
        """SELECT l.pair_id, max(best) AS m FROM lcs l JOIN rtok t ON t.pair_id = l.pair_id
           WHERE step = len(t.g) GROUP BY l.pair_id""",
    ),
]


def _f(m: str, r: str, g: str) -> str:
    p, c = f"{m} / greatest({g}, 1)", f"{m} / greatest({r}, 1)"
    return f"CASE WHEN coalesce({m}, 0) = 0 THEN 0 ELSE 2 * ({p}) * ({c}) / (({p}) + ({c})) END"


_ROUGE_BODY = f"""SELECT pair_id, {_f('o1.m', 'len(r)', 'len(g)')} AS rouge_1,
    {_f('o2.m', 'len(r) - 1', 'len(g) - 1')} AS rouge_2, {_f('ol.m', 'len(r)', 'len(g)')} AS rouge_l
    FROM rtok LEFT JOIN o1 USING (pair_id) LEFT JOIN o2 USING (pair_id) LEFT JOIN ol USING (pair_id)"""


def _distinct(n: int, digits: int) -> str:
    return f"""SELECT count(*) AS n_unique, CAST(sum(c) AS BIGINT) AS n_total,
        round(count(*) / sum(c), {digits}) AS value
        FROM ({_grams(f"(SELECT 0 AS z, {_words('lower(generated)')} AS w FROM pairs)", 'w', n, 'z')})"""


def _lm(n: int) -> list[tuple[str, str]]:
    toks = _words("lower(text)")
    shared = [
        ("wc", f"""SELECT w, count(*) AS c FROM (SELECT unnest({toks}) AS w FROM split WHERE split = 'train')
            GROUP BY w"""),
        ("size", "SELECT count(*) AS v, sum(c) AS t FROM wc"),
    ]
    if n == 1:
        return shared + [
            ("tw", f"SELECT row_id, unnest({toks}) AS w FROM split WHERE split = 'val'"),
            ("losses", """SELECT row_id, avg(-ln((coalesce(c, 0) + 1) / (t + v + 1))) AS loss
                FROM tw LEFT JOIN wc USING (w), size GROUP BY row_id"""),
        ]
    both = f"""SELECT row_id, split, s[i] AS a, s[i + 1] AS b FROM
        (SELECT row_id, split, s, unnest(range(1, len(s))) AS i FROM
         (SELECT row_id, split, list_concat(['<s>'], {toks}) AS s FROM split))"""
    return shared + [
        ("bi", both),
        ("bc", "SELECT a, b, count(*) AS c FROM bi WHERE split = 'train' GROUP BY ALL"),
        ("ctx", "SELECT a, sum(c) AS t FROM bc GROUP BY a"),
        ("losses", """SELECT row_id,
            avg(-ln((coalesce(c, 0) + 1) / (coalesce(ctx.t, 0) + v + 1))) AS loss
            FROM bi LEFT JOIN bc USING (a, b) LEFT JOIN ctx USING (a), size
            WHERE split = 'val' GROUP BY row_id"""),
    ]


def _describe(source: str, col: str, digits: int) -> str:
    quart = ", ".join(
        f"quantile_cont(CAST({col} AS DOUBLE), {p / 100}) AS p{p}" for p in (25, 50, 75)
    )
    return f"""SELECT count({col}) AS count, round(avg({col}), {digits}) AS mean,
        round(stddev_samp({col}), {digits}) AS std, CAST(min({col}) AS DOUBLE) AS min, {quart},
        CAST(max({col}) AS DOUBLE) AS max FROM {source}"""


_PARSED_REQUESTS = f"""SELECT query_id, p_brand, name,
    CASE WHEN p_brand = 'Brand#3' THEN '' ELSE category END AS category, color,
    CASE WHEN p_brand = 'Brand#3' THEN {fixed.DEFAULT_TOP_K} ELSE top_k END AS top_k
    FROM req JOIN part ON p_partkey = query_id"""

_EXAMPLE = """'Example ' || CAST(pos AS VARCHAR) || ':' || chr(10) || 'Product: ' || name_clean || chr(10)
    || CASE WHEN colors_extracted <> '' THEN '    Color: ' || colors_extracted || chr(10) ELSE '' END
    || '    Description: ' || fulldescription_clean || chr(10)"""

_COLUMNS = ["row_id", "name", "fulldescription", "colorname"]
_ORDERS = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]

_SEQ = [
    (
        "parted",
        f"""SELECT row_id, prompt, CASE WHEN {_hash(_seeded('row_id'))} % 1000 <
        {round(fixed.VALIDATION_SHARE * 1000)} THEN 'val' ELSE 'train' END AS split FROM prompted""",
    ),
    ("vocab_source", "SELECT prompt AS src FROM parted WHERE split = 'train'"),
    ("vocab", _CTE["vocab"]),
    (
        "coded",
        f"""SELECT row_id, list(coalesce(id, {fixed.UNKNOWN_ID}) ORDER BY i) AS ids FROM
        (SELECT row_id, w[i] AS token, i FROM
         (SELECT row_id, w, unnest(range(1, least(len(w), {fixed.SEQUENCE_LENGTH}) + 1)) AS i FROM
          (SELECT row_id, {_words('lower(prompt)')} AS w FROM parted)))
        LEFT JOIN vocab USING (token) GROUP BY row_id""",
    ),
]


def _padded(ids: str, fill: str) -> str:
    return f"""array_to_string(list_concat({ids}, list_transform(range({fixed.SEQUENCE_LENGTH} - len(ids)),
        lambda x: {fill})), ' ')"""


def oracle_queries() -> dict[str, str]:
    sql: dict[str, str] = {}

    # cleaning
    sql["raw_columns"] = _with(["cat"], "SELECT * FROM cat")
    sql["null_sentinels"] = _with(
        ["cat"],
        "SELECT row_id, " + ", ".join(f"nullif({c}, '[]') AS {c}" for c in _COLUMNS[1:]) + " FROM cat",
    )
    sql["basic_cleaning"] = _with(["base"], "SELECT * FROM base")
    sql["parse_list_cells"] = """SELECT p_partkey, CASE p_type
        WHEN 'ECONOMY' THEN p_name || ' ' || p_brand || '''s'
        WHEN 'SMALL' THEN p_name || ' ' || p_size || ' None'
        WHEN 'LARGE' THEN '[''' || p_name || '''] x'
        WHEN 'MEDIUM' THEN '(''' || p_name || ''', ''b'')'
        ELSE p_name END AS parsed FROM part"""
    sql["extract_color_cells"] = f"""SELECT p_partkey, CASE p_type
        WHEN 'ECONOMY' THEN {_FIRST} || ', blue' WHEN 'LARGE' THEN '' ELSE 'unknown' END AS colors FROM part"""
    sql["clean_documents"] = f"SELECT doc_id AS row_id, {_clean('text')} AS clean FROM documents"
    sql["clean_pages"] = f"SELECT page_id, {_clean('html')} AS clean FROM pages"
    sql["clean_names"] = "SELECT p_partkey, p_name AS name_clean FROM part"
    sql["stopwords_removed"] = f"SELECT page_id, {_kept(_clean('html'))} AS kept FROM pages"
    sql["word_counts"] = f"SELECT doc_id AS row_id, {_count('text')} AS words FROM documents"
    sql["filter_short_documents"] = f"""SELECT doc_id AS row_id, {_count('text')} AS desc_word_count
        FROM documents WHERE {_count('text')} >= {fixed.MIN_WORDS}"""
    sql["dedup_documents"] = "SELECT min(doc_id) AS row_id FROM documents GROUP BY text"
    sql["preprocess_catalog"] = _with(["preprocessed"], "SELECT * FROM preprocessed")
    sql["catalog_features"] = _with(["features"], "SELECT * FROM features")

    # sources and sinks
    sql["catalog_csv"] = sql["raw_columns"]
    sql["features_parquet"] = sql["features_csv"] = sql["catalog_features"]
    sql["validation_prompts"] = _with(
        ["prompted"], "SELECT row_id, prompt FROM parted WHERE split = 'val'", _SEQ[0]
    )
    sql["vector_index"] = _with(
        ["emb"],
        """SELECT row_id, name_clean, colors_extracted, fulldescription_clean,
        CAST(n AS INTEGER) AS n_buckets FROM features
        JOIN (SELECT row_id, count(*) AS n FROM emb GROUP BY row_id) USING (row_id)""",
    )
    sql["index_size"] = _with(
        ["features"],
        f"""SELECT count(*) AS n_vectors, CAST({fixed.EMBEDDING_DIM} AS INTEGER) AS min_dim,
        CAST({fixed.EMBEDDING_DIM} AS INTEGER) AS max_dim FROM features""",
    )
    sql["batch_requests"] = _with(
        ["req"],
        f"""SELECT query_id, name, color, '' AS category, CAST({fixed.DEFAULT_TOP_K} AS INTEGER) AS top_k
        FROM req WHERE category <> 'bolt'""",
    )
    sql["batch_results"] = _with(
        _ASKED,
        """SELECT query_id, name, final_color AS color, '' AS description,
        coalesce(top_similar, '') AS top_similar FROM enriched""",
        *_ENRICHED,
    )
    sql["accepted_requests"] = _with(
        ["req"],
        """SELECT query_id, name, color, category, CAST(top_k AS INTEGER) AS top_k FROM parsed
        WHERE p_brand NOT IN ('Brand#1', 'Brand#2')""",
        ("parsed", _PARSED_REQUESTS),
    )
    sql["rejected_requests"] = f"""SELECT p_partkey AS query_id, CASE p_brand WHEN 'Brand#1'
        THEN '{fixed.MISSING_NAME}' ELSE '{fixed.EMPTY_NAME}' END AS error
        FROM part WHERE p_brand IN ('Brand#1', 'Brand#2')"""
    sql["response_documents"] = _with(
        _ASKED,
        """SELECT query_id, name, color, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) - 1
        AS INTEGER) AS pos, name_clean AS product, colors_extracted AS product_color,
        similarity_score AS score FROM filtered""",
        *_FILTERED,
    )
    streamed = (
        [("parsed", _PARSED_REQUESTS),
         ("valid", "SELECT * FROM parsed WHERE p_brand NOT IN ('Brand#1', 'Brand#2')")]
        + _dense("valid", "5")
        + [("hits", "SELECT * FROM dhits WHERE rank <= top_k")]
        + _FILTERED[-2:]
    )
    sql["request_stream"] = _with(
        _ASKED,
        """SELECT query_id, valid.name, valid.color, CAST(count(f.row_id) AS INTEGER) AS n_products
        FROM valid LEFT JOIN filtered f USING (query_id) GROUP BY ALL""",
        *streamed,
    )

    # prompts
    sql["training_prompts"] = _with(["prompted"], "SELECT row_id, prompt, prompt_length FROM prompted")
    sql["prompt_length_stats"] = _with(["prompted"], _describe("prompted", "prompt_length", 6))
    sql["product_texts"] = _with(["texts"], "SELECT row_id, product_text FROM texts")
    sql["query_texts"] = _with(
        ["req"],
        """SELECT query_id, 'Product: ' || name || CASE WHEN color <> ''
        THEN chr(10) || 'Color: ' || color ELSE '' END AS query_text FROM req""",
    )
    sql["keyword_tokens"] = _with(
        ["bdoc"], "SELECT row_id, array_to_string(tokens, '|') AS tokens FROM bdoc"
    )
    sql["inference_prompts"] = _with(
        ["req"],
        f"""SELECT query_id, {_fill(fixed.INFERENCE_PROMPT, name='name', color='color')} AS prompt
        FROM req""",
    )
    sql["fewshot_prompts"] = _with(
        _ASKED,
        f"""SELECT query_id, md5({_q(fixed.FEWSHOT_HEADER)} || chr(10) || examples || chr(10)
        || {_q(fixed.FEWSHOT_RULE)} || chr(10) || {_q(fixed.FEWSHOT_ASK)} || chr(10)
        || {_fill(fixed.INFERENCE_PROMPT, name='name', color='color')}) AS prompt_md5
        FROM req JOIN (SELECT query_id, string_agg({_EXAMPLE}, chr(10) ORDER BY pos) AS examples FROM
            (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS pos FROM filtered)
            GROUP BY query_id) USING (query_id)""",
        *_FILTERED,
    )
    cut = "strpos(prompt, 'Description: ') + 12"
    sql["split_prompts"] = _with(
        ["prompted"],
        f"""SELECT row_id, substr(prompt, 1, {cut}) AS input, {_strip(f'substr(prompt, {cut} + 1)')}
        AS reference FROM prompted""",
    )
    sql["stripped_prefixes"] = _with(
        ["pairs"],
        f"""SELECT pair_id, {_strip('generated')} AS cut,
        {_strip("CASE WHEN starts_with(generated, reference) THEN substr(generated, length(reference) + 1) ELSE generated END")}
        AS kept, {_strip('generated')} AS always_cut FROM pairs""",
    )
    sql["previews"] = "SELECT doc_id AS row_id, " + ", ".join(
        f"substr(text, 1, {n}) AS preview_{name}" for name, n in fixed.PREVIEW_CHARS.items()
    ) + " FROM documents"
    sql["metric_tokens"] = _with(
        ["pairs"],
        f"""SELECT pair_id, array_to_string({_treebank('lower(generated)')}, '|') AS bleu_gen,
        array_to_string({_alnum('generated')}, '|') AS rouge_gen,
        array_to_string({_words('lower(generated)')}, '|') AS plain FROM pairs""",
    )
    sql["request_defaults"] = _with(
        ["req"],
        f"""SELECT query_id, name, CASE color WHEN 'red' THEN '' ELSE color END AS color, '' AS category,
        CAST(CASE top_k WHEN 1 THEN {fixed.DEFAULT_TOP_K} ELSE top_k END AS INTEGER) AS top_k FROM req""",
    )

    # vectors and sequences
    sql["hashed_tfidf"] = _with(["emb"], "SELECT row_id, bucket, round(weight, 5) AS weight FROM emb")
    sql["normalized_vectors"] = """SELECT vec_id, i - 1 AS dim, round(v[i] / sqrt(list_inner_product(v, v)), 6) AS x
        FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM
        (SELECT vec_id, CAST(list_transform(embedding, lambda x: CAST(x * 3 AS FLOAT)) AS DOUBLE[]) AS v
         FROM embeddings))"""
    sql["vocabulary"] = _with(
        [],
        "SELECT * FROM vocab",
        ("vocab_source", "SELECT text AS src FROM documents"),
        ("vocab", _CTE["vocab"]),
    )
    ids = f"list_transform(ids, lambda x: CAST(x AS INTEGER))"
    sql["encoded_sequences"] = _with(
        ["prompted"],
        f"""SELECT row_id, split, {_padded(ids, str(fixed.PAD_ID))} AS input_ids,
        {_padded('list_transform(ids, lambda x: 1)', '0')} AS attention_mask,
        {_padded(ids, str(fixed.PAD_ID))} AS labels FROM coded JOIN parted USING (row_id)""",
        *_SEQ,
    )
    sql["sequence_length_range"] = f"""SELECT CAST({fixed.SEQUENCE_LENGTH} AS INTEGER) AS min_length,
        CAST({fixed.SEQUENCE_LENGTH} AS INTEGER) AS max_length"""
    sql["raw_length_range"] = _with(
        ["prompted"], "SELECT min(prompt_length) AS min_length, max(prompt_length) AS max_length FROM prompted"
    )
    sql["prompts_only"] = _with(["prompted"], "SELECT row_id, prompt FROM prompted")
    sql["model_scores"] = """SELECT doc_id AS row_id, length(text) AS chars,
        len(string_split(text, ' ')) AS pieces FROM documents"""

    # retrieval
    sql["nearest_vectors"] = """SELECT query_id, row_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score
        FROM (SELECT q.vec_id AS query_id, r.vec_id AS row_id,
              list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS score,
              row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, r.vec_id) AS rank
              FROM embeddings q, embeddings r) WHERE rank <= 5"""
    sql["clustered_nearest_vectors"] = sql["nearest_vectors"]
    sql["dense_retrieval"] = _with(
        _ASKED,
        "SELECT query_id, rank, row_id, name_clean, colors_extracted, similarity_score FROM hits",
        *_HITS,
    )
    sql["text_retrieval"] = _with(
        ["features", "emb"],
        "SELECT query_id, rank, row_id, name_clean, similarity_score FROM dhits",
        ("free", "SELECT item_id AS query_id, text FROM benchmark"),
        *_dense("free", "5", "text"),
    )
    sql["color_filtered_hits"] = _with(
        _ASKED, "SELECT query_id, row_id FROM bycolor", *_FILTERED
    )
    sql["category_filtered_hits"] = _with(
        _ASKED,
        "SELECT query_id, row_id FROM bycategory",
        *_HITS,
        _fallback("bycategory", "hits", "name_clean", "category"),
    )
    sql["filtered_hits"] = _with(_ASKED, "SELECT query_id, row_id, rank FROM filtered", *_FILTERED)
    sql["keyword_corpus"] = _with(
        ["bdoc"], "SELECT count(*) AS n_docs, avg(len(tokens)) AS avgdl FROM bdoc"
    )
    sql["keyword_terms"] = _with(["bterm"], "SELECT t AS term, df, round(idf, 6) AS idf FROM bterm")
    sql["keyword_retrieval"] = _with(
        ["features", "bterm", "req"],
        "SELECT query_id, rank, row_id, name_clean, similarity_score FROM khits",
        *_keyword("req", "6"),
    )
    sql["hybrid_retrieval"] = _with(
        [*_ASKED, "bterm"],
        "SELECT query_id, rank, row_id, name_clean, source, similarity_score FROM merged",
        *_dense("req", "10"),
        *_keyword("req", "10"),
        _merged("5"),
    )
    sql["retrieval_plans"] = _with(
        ["plan"],
        f"""SELECT query_id, retrieval_strategy, planned_top_k, array_to_string(
            list_filter(words, lambda w, i: list_position(words, w) = i), ' ') AS keywords
        FROM (SELECT *, {_words("lower(name || ' ' || color)")} AS words FROM plan)""",
    )
    sql["planned_retrieval"] = _with(
        [*_ASKED, "bterm", "plan"],
        """SELECT query_id, rank, row_id, source FROM (
            SELECT query_id, rank, row_id, 'dense' AS source FROM dhits WHERE rank <= 5
            AND retrieval_strategy = 'dense'
            UNION ALL
            SELECT m.query_id, m.rank, m.row_id, m.source FROM merged m JOIN plan USING (query_id)
            WHERE retrieval_strategy = 'hybrid') JOIN plan USING (query_id) WHERE rank <= planned_top_k""",
        *_dense("plan", "10"),
        *_keyword("plan", "10"),
        _merged("5", "JOIN (SELECT query_id, planned_top_k AS planned FROM plan) USING (query_id) WHERE rank <= 2 * planned"),
    )
    sql["color_inference"] = _with(
        _ASKED, "SELECT query_id, final_color, enrich_status, enrich_detail FROM enriched", *_ENRICHED
    )
    sql["recommendations"] = _with(
        _ASKED,
        f"""SELECT query_id, req.name, req.color, {_fill(fixed.INFERENCE_PROMPT, name='req.name',
        color='req.color')} AS prompt, CAST(count(f.row_id) AS INTEGER) AS n_similar,
        coalesce(string_agg(f.name_clean, '|' ORDER BY f.rank), '') AS similar_names,
        coalesce(string_agg(CAST(f.row_id AS VARCHAR), '|' ORDER BY f.rank), '') AS similar_rows,
        coalesce(string_agg(format('{{:.4f}}', f.similarity_score), '|' ORDER BY f.rank), '')
        AS similar_scores
        FROM req LEFT JOIN filtered f USING (query_id) GROUP BY query_id, req.name, req.color""",
        *_FILTERED,
    )
    sql["planned_batch"] = _with(
        _ASKED,
        f"""SELECT query_id, name, final_color AS color, CAST(n AS INTEGER) AS n_similar,
        {_fill(fixed.INFERENCE_PROMPT, name='name', color='final_color')} AS prompt FROM enriched""",
        *_ENRICHED,
    )
    parse = "'name=''' || name || '''  color=''' || CASE WHEN color = '' THEN '(empty)' ELSE color END || ''''"
    written = "SELECT query_id, 'GENERATE', 'ok', 'generated 0 tokens' FROM"
    sql["plan_traces"] = _with(
        _ASKED,
        f"""SELECT query_id, 'PARSE' AS name, 'ok' AS status, {parse} AS detail FROM enriched
        UNION ALL SELECT query_id, 'RETRIEVE', 'ok', CASE WHEN n = 0 THEN '{fixed.NO_RESULTS}' ELSE
            'found ' || n || ' products  (top score: ' || format('{{:.3f}}', top_score) || ')' END FROM enriched
        UNION ALL SELECT query_id, 'ENRICH', enrich_status, enrich_detail FROM enriched
        UNION ALL {written} enriched""",
        *_ENRICHED,
    )
    sql["plan_traces_without_index"] = _with(
        ["req"],
        f"""SELECT query_id, 'PARSE' AS name, 'ok' AS status, {parse} AS detail FROM req
        UNION ALL SELECT query_id, 'RETRIEVE', 'skipped', {_q(fixed.RETRIEVAL_OFF)} FROM req
        UNION ALL SELECT query_id, 'ENRICH', 'skipped', CASE WHEN color <> ''
            THEN 'color already provided: ''' || color || '''' ELSE {_q(fixed.NOTHING_TO_INFER_FROM)} END FROM req
        UNION ALL {written} req""",
    )

    # sampling
    order = f"md5({_seeded('doc_id')}), doc_id"
    sql["sampled_documents"] = f"""SELECT doc_id AS row_id FROM documents ORDER BY {order}
        LIMIT {fixed.EVAL_SAMPLE}"""
    sql["split_documents"] = _with(["split"], "SELECT row_id, split FROM split")
    sql["split_documents_exact"] = f"""SELECT doc_id AS row_id, CASE WHEN row_number() OVER (ORDER BY {order})
        <= ceil({fixed.VALIDATION_SHARE} * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split FROM documents"""
    sql["training_complement"] = _with(["split"], "SELECT row_id FROM split WHERE split = 'train'")
    sql["first_documents"] = f"""SELECT doc_id AS row_id, text FROM documents ORDER BY doc_id
        LIMIT {fixed.PREVIEW_ROWS}"""

    # metrics
    sql["nonempty_reference_pairs"] = _with(
        ["pairs"], "SELECT pair_id FROM pairs WHERE regexp_matches(reference, '^[a-zA-Z]')"
    )
    sql["distinct_unigrams"] = _with(["pairs"], _distinct(1, 6))
    sql["distinct_bigrams"] = _with(["pairs"], _distinct(2, 6))
    sql["corpus_bleu"] = _with(
        ["pairs"],
        "SELECT *, "
        + ", ".join(
            f"round({_bleu_value(w)}, 6) AS {name.lower().replace('-', '_')}"
            for name, w in fixed.BLEU_WEIGHTS.items()
        )
        + " FROM sums",
        *_BLEU,
    )
    sql["pair_rouge"] = _with(
        ["pairs"],
        f"""SELECT pair_id, round(rouge_1, 6) AS rouge_1, round(rouge_2, 6) AS rouge_2,
        round(rouge_l, 6) AS rouge_l FROM ({_ROUGE_BODY})""",
        *_ROUGE,
        recursive=True,
    )
    sql["finite_losses"] = _with(
        ["losses"], "SELECT row_id, loss FROM losses WHERE isfinite(loss)"
    )
    sql["event_perplexity"] = _with(
        ["losses"], "SELECT round(exp(avg(loss)), 6) AS perplexity FROM losses WHERE isfinite(loss)"
    )
    for name, n in (("unigram_losses", 1), ("bigram_losses", 2)):
        sql[name] = _with(
            ["split"], "SELECT row_id, round(loss, 6) AS loss FROM losses", *_lm(n)
        )
    bleu_rows = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {_bleu_value(w)} AS value FROM sums"
        for name, w in fixed.BLEU_WEIGHTS.items()
    )
    sql["evaluation_report"] = _with(
        ["pairs", "split"],
        f"""SELECT metric, round(value, 4) AS value FROM ({bleu_rows}
        UNION ALL SELECT 'ROUGE-1', avg(rouge_1) FROM rouge
        UNION ALL SELECT 'ROUGE-2', avg(rouge_2) FROM rouge
        UNION ALL SELECT 'ROUGE-L', avg(rouge_l) FROM rouge
        UNION ALL SELECT 'Avg Generation Time', avg(length(generated) / 100) FROM pairs
        UNION ALL SELECT 'Distinct-1', value FROM ({_distinct(1, 12)})
        UNION ALL SELECT 'Distinct-2', value FROM ({_distinct(2, 12)})
        UNION ALL SELECT 'Perplexity', exp(avg(loss)) FROM losses)""",
        *_BLEU,
        *_ROUGE,
        ("rouge", _ROUGE_BODY),
        *_lm(1),
        recursive=True,
    )
    reference = _strip(f"substr(prompt, {cut} + 1)")
    sql["evaluation_pairs"] = _with(
        ["prompted"],
        f"""SELECT row_id AS pair_id, substr(prompt, 1, {cut}) AS input, {reference} AS reference,
        {reference} AS generated FROM prompted WHERE {reference} <> ''""",
    )
    sql["mean_generation_time"] = _with(
        ["pairs"], "SELECT round(avg(length(generated) / 100), 6) AS mean_seconds FROM pairs"
    )

    # profiling
    sql["document_length_stats"] = _describe("documents", "n_chars", 4)
    sql["document_length_histogram"] = f"""SELECT CAST(b AS INTEGER) AS bin, count(n_chars) AS n
        FROM range({fixed.HISTOGRAM_BINS}) r(b) LEFT JOIN
        (SELECT n_chars, least(floor((n_chars - lo) / (hi - lo) * {fixed.HISTOGRAM_BINS}),
            {fixed.HISTOGRAM_BINS - 1}) AS spot
         FROM documents, (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents)) ON spot = b
        GROUP BY b"""
    sql["stage_counts"] = _with(
        ["features"],
        """SELECT 'raw' AS stage, count(*) AS n_rows FROM cat
        UNION ALL SELECT 'preprocessed', count(*) FROM preprocessed
        UNION ALL SELECT 'features', count(*) FROM features""",
    )
    sql["table_counts"] = """SELECT 'documents' AS stage, count(*) AS n_rows FROM documents
        UNION ALL SELECT 'distinct', count(DISTINCT text) FROM documents"""
    sql["sentinel_counts"] = _with(
        ["cat"],
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (CAST({c} AS VARCHAR) = '[]') AS n_sentinel FROM cat"
            for c in _COLUMNS
        ),
    )
    sql["null_counts"] = _with(
        ["cat"],
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (nullif(CAST({c} AS VARCHAR), '[]') IS NULL) AS n_nulls"
            " FROM cat"
            for c in _COLUMNS
        ),
    )
    sql["table_profile"] = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name, '{kind}' AS data_type, "
        "count(*) AS n_rows FROM orders"
        for i, (name, kind) in enumerate(_ORDERS)
    )
    return sql
