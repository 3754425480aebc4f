"""The registered linkage queries over the driver's tables, each with its SQL equivalent where SQL has one.

Roles: suppliers are source 1, customers source 2 and parts source 3; a supplier and the
customer (and, for every fifth, the part) of the same key are one business. Ranked lists
are customers' orders by price and by date, scored pairs are suppliers' parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from korvane.functions import similarity as sim
from korvane.functions import text, vocab
from korvane.operators import decision, evaluate, features, fusion, lexical, negatives, profile, stress, vector
from korvane.operators.matcher import PairMatcher
from korvane.plans.linkage import Settings
from korvane.plans.registry import query
from korvane.session import cut, scratch, table

_S1 = """
SELECT concat('S1-', s_suppkey) AS entity_id,
  concat(s_name, CASE s_suppkey % 4 WHEN 0 THEN ' Pvt. Ltd.' WHEN 1 THEN ' & Co' WHEN 2 THEN concat(' dba ', n_name, ' Works') ELSE concat(' | www.', lower(n_name), '.com') END) AS business_name,
  concat(s_suppkey, ' ', n_name, ' Rd., Apt ', s_nationkey, ', near ', r_name, ' Main Hall, ', 100000 + s_suppkey) AS business_address, r_name AS country
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_S2 = """
SELECT concat('S2-', c_custkey) AS entity_id,
  concat(replace(c_name, 'Customer', 'Supplier'), CASE c_custkey % 3 WHEN 0 THEN ' Private Limited' WHEN 1 THEN ' and Co.' ELSE '' END) AS business_name,
  concat(c_custkey, ' ', n_name, ' Road Apartment ', c_nationkey, ' ', 100000 + c_custkey) AS business_address, r_name AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_S3 = """
SELECT concat('S3-', p_partkey) AS entity_id, concat(p_name, ' ', p_brand) AS business_name,
  concat(p_type, ' Ave ##', p_size, ', box ', 10000 + p_partkey) AS business_address, '' AS country FROM part"""
_ALL = f"{_S1} UNION ALL {_S2} UNION ALL {_S3}"
_LINKS = """
SELECT concat('S1-', s_suppkey) AS s1_id, concat('S2-', c_custkey) AS cand_id FROM supplier JOIN customer ON s_suppkey = c_custkey
UNION ALL SELECT concat('S1-', s_suppkey), concat('S3-', p_partkey) FROM supplier JOIN part ON s_suppkey = p_partkey WHERE s_suppkey % 5 = 0"""
_RANKED = """
SELECT 'price' AS retriever, o_custkey AS qid, o_orderkey AS cand_id, o_totalprice AS score, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders
UNION ALL SELECT 'date', o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) FROM orders WHERE o_orderstatus <> 'P'"""
_SCORED = "SELECT l_suppkey AS s1_id, l_partkey AS cand_id, max(l_quantity * (1 - l_discount)) / 50 AS score, l_suppkey AS s1_pos FROM lineitem GROUP BY l_suppkey, l_partkey"
_TRUE_PAIRS = "SELECT l_suppkey AS s1_id, l_partkey AS cand_id FROM lineitem GROUP BY l_suppkey, l_partkey HAVING max(l_quantity) >= 45"


def _sql(spark: SparkSession, sf_dir: str, text_: str, *names: str) -> DataFrame:
    """SQL over the named tables, read from sf_dir."""
    return spark.sql(_bound(text_, names), **{n: table(spark, sf_dir, n) for n in names})


def _bound(text_: str, names: tuple[str, ...]) -> str:
    """The SQL with table names in braces, as spark.sql() binds DataFrames."""
    import re

    return re.sub(rf"\b(FROM|JOIN) ({'|'.join(names)})\b", r"\1 {\2}", text_)


_STAR = ("supplier", "customer", "part", "nation", "region")


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(source 1, pool)."""
    s1 = _sql(spark, d, _S1, "supplier", "nation", "region")
    return s1, _sql(spark, d, f"{_S2} UNION ALL {_S3}", "customer", "part", "nation", "region")


def _everything(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, _ALL, *_STAR)


def _truth(spark: SparkSession, d: str) -> DataFrame:
    links = _sql(spark, d, _LINKS, "supplier", "customer", "part")
    ids = table(spark, d, "supplier").select(F.concat(F.lit("S1-"), "s_suppkey").alias("s1_id"))
    by = links.groupBy("s1_id").agg(F.array_sort(F.collect_list("cand_id")).alias("matches"))
    return ids.join(by, "s1_id", "left").withColumn("matches", F.coalesce("matches", F.array().cast("array<string>")))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, _SCORED, "lineitem")


def _pair_truth(spark: SparkSession, d: str) -> DataFrame:
    by = _sql(spark, d, _TRUE_PAIRS, "lineitem").groupBy("s1_id").agg(F.collect_list("cand_id").alias("matches"))
    ids = table(spark, d, "supplier").select(F.col("s_suppkey").alias("s1_id"))
    return ids.join(by, "s1_id", "left").withColumn("matches", F.coalesce("matches", F.array().cast("array<bigint>")))


def _r(c: str, digits: int = 6):
    return F.round(c, digits).alias(c)


# ---- names and addresses

def _sql_map(values: dict[str, str]) -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'"
    return f"MAP {{{', '.join(f'{q(k)}: {q(v)}' for k, v in values.items())}}}"


def _dba_sql(column: str) -> str:
    whens = "".join(f" WHEN regexp_matches({column}, '{m}', 'i') THEN [regexp_extract({column}, '(?is)^(.*?)(?:{m})(.*)$', 1), regexp_extract({column}, '(?is)^(.*?)(?:{m})(.*)$', 2)]" for m in vocab.DBA_MARKS)
    return f"CASE{whens} WHEN contains({column}, '|') THEN [split_part({column}, '|', 1), substr({column}, instr({column}, '|') + 1)] ELSE [{column}, ''] END"


_NAME_SQL = f"""
WITH a AS (SELECT entity_id, trim(regexp_replace(regexp_replace(regexp_replace(business_name, 'https?://\\S+', '', 'g'), 'www\\.\\S+', '', 'g'), '\\b\\w+\\.(com|org|net|co\\.in|in|edu)\\b', '', 'gi')) AS n FROM ({_ALL})),
b AS (SELECT entity_id, n, {_dba_sql('n')} AS d FROM a),
c AS (SELECT entity_id, trim(d[2]) AS dba_name, CASE WHEN trim(d[1]) <> '' THEN trim(d[1]) ELSE n END AS n FROM b),
e AS (SELECT entity_id, dba_name, list_filter(string_split_regex(lower(trim(regexp_replace(regexp_replace(n, '[/\\\\|,;:]+', ' ', 'g'), '["''\\[\\]{{}}()*#]+', ' ', 'g'))), '\\s+'), lambda x: x <> '') AS t FROM c),
f AS (SELECT entity_id, dba_name, list_transform(t, lambda x: coalesce({_sql_map(vocab.NAME_TOKENS)}[x], x)) AS t FROM e),
g AS (SELECT *, list_transform([1, 2, 3], lambda k: CASE WHEN len(t) >= k THEN {_sql_map(vocab.LEGAL_SUFFIXES)}[regexp_replace(t[len(t) - k + 1], '[.,]+$', '')] END) AS s FROM f),
h AS (SELECT *, CASE WHEN s[1] IS NULL THEN 0 WHEN s[2] IS NULL THEN 1 WHEN s[3] IS NULL THEN 2 ELSE 3 END AS k FROM g)
SELECT entity_id, array_to_string(t, ' ') AS cleaned, array_to_string(t[1:len(t) - k], ' ') AS name_only, array_to_string(list_reverse(s[1:k]), ' ') AS legal_suffix, dba_name,
  array_to_string(list_transform(list_filter(t[1:len(t) - k], lambda x: length(x) > 1 AND regexp_matches(x, '^[a-z]+$')), lambda x: x[1:1]), '') AS acronym FROM h"""


@query("name_parts", _NAME_SQL)
def name_parts(spark: SparkSession, d: str) -> DataFrame:
    p = _everything(spark, d).select("entity_id", text.name_parts(F.col("business_name")).alias("p"))
    return p.select("entity_id", "p.cleaned", "p.name_only", "p.legal_suffix", "p.dba_name", "p.acronym")


_LANDMARK_SQL = f"(?:{vocab.LANDMARK_WORDS})\\s+(\\S+(?:\\s+\\S+){{0,3}})"


def _address_cleaned(c: str) -> str:
    clean = f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '[\"''\\[\\]{{}}()*]+', ' ', 'g'), '#+', '#', 'g'), '[,;]+', ', ', 'g'), '\\s+', ' ', 'g'))"
    return f"array_to_string(list_transform(list_filter(string_split_regex(lower({clean}), '\\s+'), lambda x: x <> ''), lambda x: coalesce({_sql_map(vocab.ADDRESS_TOKENS)}[regexp_replace(x, '[.,]+$', '')], x)), ' ')"


@query("address_parts", f"""
SELECT entity_id, {_address_cleaned('business_address')} AS cleaned,
  array_to_string(regexp_extract_all(business_address, '\\b\\d+(?:[/-]\\d+)*\\b'), '|') AS numbers,
  CASE WHEN regexp_matches(business_address, '\\b\\d{{6}}\\b') THEN regexp_extract(business_address, '\\b(\\d{{6}})\\b', 1) ELSE regexp_extract(business_address, '\\b(\\d{{5}})(?:-\\d{{4}})?\\b', 1) END AS pin_zip,
  array_to_string(regexp_extract_all(business_address, '(?i)\\b{_LANDMARK_SQL}', 1), ' ') AS landmarks FROM ({_ALL})""")
def address_parts(spark: SparkSession, d: str) -> DataFrame:
    p = _everything(spark, d).select("entity_id", text.address_parts(F.col("business_address")).alias("p"))
    return p.select("entity_id", "p.cleaned", F.array_join("p.numbers", "|").alias("numbers"), "p.pin_zip", "p.landmarks")


# ---- similarities of true pairs

def _linked(spark: SparkSession, d: str) -> DataFrame:
    s1, pool = _records(spark, d)
    links = _sql(spark, d, _LINKS, "supplier", "customer", "part")
    a = s1.select(F.col("entity_id").alias("s1_id"), F.lower("business_name").alias("a"), F.lower("business_address").alias("a2"))
    b = pool.select(F.col("entity_id").alias("cand_id"), F.lower("business_name").alias("b"), F.lower("business_address").alias("b2"))
    return links.join(a, "s1_id").join(b, "cand_id")


_LINKED_SQL = f"SELECT l.s1_id, l.cand_id, lower(x.business_name) AS a, lower(y.business_name) AS b, lower(x.business_address) AS a2, lower(y.business_address) AS b2 FROM ({_LINKS}) l JOIN ({_S1}) x ON x.entity_id = l.s1_id JOIN ({_S2} UNION ALL {_S3}) y ON y.entity_id = l.cand_id"


def _jaccard_sql(x: str, y: str) -> str:
    return f"CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y})) / len(list_distinct(list_concat({x}, {y}))) END"


def _grams_sql(c: str, n: int) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({c}) - {n} + 2, 1)), lambda i: substr({c}, CAST(i AS BIGINT), {n})))"


_TOKENS = "list_distinct(list_filter(string_split_regex({}, '\\s+'), lambda t: t <> ''))"
_NUMS = "list_distinct(regexp_extract_all({}, '\\b\\d+(?:[/-]\\d+)*\\b'))"


@query("pair_similarity", f"""
SELECT s1_id, cand_id, round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 6) AS levenshtein, round(jaro_winkler_similarity(a, b), 6) AS jaro_winkler,
  round({_jaccard_sql(_TOKENS.format('a'), _TOKENS.format('b'))}, 6) AS token_jaccard,
  round({_jaccard_sql(_grams_sql('a', 3), _grams_sql('b', 3))}, 6) AS char3_jaccard, round({_jaccard_sql(_grams_sql('a', 4), _grams_sql('b', 4))}, 6) AS char4_jaccard,
  round(least(length(a), length(b)) / greatest(length(a), length(b)), 6) AS length_ratio,
  round(CASE WHEN len({_NUMS.format('a2')}) = 0 OR len({_NUMS.format('b2')}) = 0 THEN 0.5 ELSE len(list_intersect({_NUMS.format('a2')}, {_NUMS.format('b2')})) / greatest(len({_NUMS.format('a2')}), len({_NUMS.format('b2')})) END, 6) AS number_agreement
FROM ({_LINKED_SQL})""")
def pair_similarity(spark: SparkSession, d: str) -> DataFrame:
    a, b, a2, b2 = map(F.col, ("a", "b", "a2", "b2"))
    made = {
        "levenshtein": sim.levenshtein_ratio(a, b), "jaro_winkler": sim.jaro_winkler(a, b), "token_jaccard": sim.token_jaccard(a, b), "char3_jaccard": sim.char_ngram_jaccard(a, b, 3),
        "char4_jaccard": sim.char_ngram_jaccard(a, b, 4), "length_ratio": sim.length_ratio(a, b), "number_agreement": sim.number_agreement(a2, b2),
    }
    return _linked(spark, d).select("s1_id", "cand_id", *[F.round(c, 6).alias(n) for n, c in made.items()])


@query("pair_ratios")
def pair_ratios(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    made = {f"{n}_{m}": f(a, b, m) for m in ("edit", "difflib") for n, f in (("token_sort", sim.token_sort_ratio), ("token_set", sim.token_set_ratio), ("partial", sim.partial_ratio), ("levenshtein", sim.levenshtein_ratio))}
    return _linked(spark, d).select("s1_id", "cand_id", *[F.round(c, 6).alias(n) for n, c in made.items()])


# ---- retrieval

def _named(df: DataFrame) -> DataFrame:
    return df.select("entity_id", F.lower("business_name").alias("name_clean"), F.lower("business_address").alias("addr_clean"))


_POOL_SQL = f"SELECT entity_id, lower(business_name) AS n, lower(business_address) AS a FROM ({_S2} UNION ALL {_S3})"
_OWN_SQL = f"SELECT entity_id, lower(business_name) AS n, lower(business_address) AS a FROM ({_S1})"
_CHAR_WB = "flatten(list_transform(list_filter(string_split_regex({}, '\\s+'), lambda w: w <> ''), lambda w: flatten(list_transform([3, 4], lambda k: list_transform(range(1, greatest(length(w) + 2 - k + 2, 1)), lambda i: substr(concat(' ', w, ' '), CAST(i AS BIGINT), CAST(k AS BIGINT)))))))"


@query("tfidf_topk", f"""
WITH p AS ({_POOL_SQL}), q AS ({_OWN_SQL}),
pc AS (SELECT entity_id, field, term, count(*) AS tf FROM (SELECT entity_id, 'n' AS field, unnest({_CHAR_WB.format('n')}) AS term FROM p UNION ALL SELECT entity_id, 'a', unnest({_CHAR_WB.format('a')}) FROM p) GROUP BY ALL),
qc AS (SELECT entity_id, field, term, count(*) AS tf FROM (SELECT entity_id, 'n' AS field, unnest({_CHAR_WB.format('n')}) AS term FROM q UNION ALL SELECT entity_id, 'a', unnest({_CHAR_WB.format('a')}) FROM q) GROUP BY ALL),
v AS (SELECT field, term, ln((1 + (SELECT count(*) FROM p)) / (1 + count(*))) + 1 AS idf FROM pc GROUP BY ALL HAVING count(*) >= 2),
pw AS (SELECT entity_id, field, term, (1 + ln(tf)) * idf AS w FROM pc JOIN v USING (field, term)),
qw AS (SELECT entity_id, field, term, (1 + ln(tf)) * idf AS w FROM qc JOIN v USING (field, term)),
pn AS (SELECT entity_id, field, sqrt(sum(w * w)) AS s FROM pw GROUP BY ALL), qn AS (SELECT entity_id, field, sqrt(sum(w * w)) AS s FROM qw GROUP BY ALL),
x AS (SELECT qw.entity_id AS qid, pw.entity_id AS cand_id, sum(CASE qw.field WHEN 'n' THEN 0.6 ELSE 0.4 END * qw.w / qn.s * pw.w / pn.s) AS score
  FROM qw JOIN pw USING (field, term) JOIN qn ON qn.entity_id = qw.entity_id AND qn.field = qw.field JOIN pn ON pn.entity_id = pw.entity_id AND pn.field = pw.field GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, cand_id) AS rank FROM x)
SELECT qid, cand_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10""")
def tfidf_topk(spark: SparkSession, d: str) -> DataFrame:
    s1, pool = map(_named, _records(spark, d))
    model = lexical.fit_tfidf(cut(pool, "pool"), max_features=10**9)
    return lexical.tfidf_topk(model, s1, 10).select("qid", "cand_id", _r("score"), F.col("rank").cast("long").alias("rank"))


@query("token_block", f"""
WITH i AS (SELECT entity_id, unnest(list_distinct(list_filter(string_split_regex(concat(n, ' ', a), '\\s+'), lambda t: length(t) >= 3))) AS token FROM ({_POOL_SQL})),
q AS (SELECT entity_id AS qid, unnest(list_distinct(list_filter(string_split_regex(concat(n, ' ', a), '\\s+'), lambda t: length(t) >= 3))) AS token FROM ({_OWN_SQL})),
f AS (SELECT token FROM i GROUP BY token HAVING count(*) < 0.1 * (SELECT count(DISTINCT token) FROM i)),
p AS (SELECT DISTINCT qid, i.entity_id AS cand_id FROM q JOIN f USING (token) JOIN i USING (token)),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY cand_id) AS nth FROM p)
SELECT qid, cand_id FROM r WHERE nth <= 500""")
def token_block(spark: SparkSession, d: str) -> DataFrame:
    s1, pool = map(_named, _records(spark, d))
    return lexical.token_block(pool, s1)


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("entity_id"), "embedding")


@query("vector_topk", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT a.vec_id AS qid, b.vec_id AS cand_id, list_inner_product(a.v, b.v) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, cand_id) AS rank FROM x)
SELECT qid, cand_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10""")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    return vector.exact_topk(v, v, 10, skip_self=True).select("qid", "cand_id", _r("score"), F.col("rank").cast("long").alias("rank"))


@query("ivf_topk")
def ivf_topk(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    return vector.ivf_topk(v, v, 10).select("qid", "cand_id", _r("score"), F.col("rank").cast("long").alias("rank"))


# ---- fusion

def _ranked(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, _RANKED, "orders")


_FUSED = f"""
WITH k AS ({_RANKED}), s AS (SELECT qid, cand_id, sum(0.5 / (60 + rank)) AS fused, min(CASE retriever WHEN 'price' THEN 0 ELSE 1 END) AS first FROM k GROUP BY qid, cand_id),
t AS (SELECT s.*, k.rank AS first_rank FROM s JOIN k ON k.qid = s.qid AND k.cand_id = s.cand_id AND k.retriever = CASE s.first WHEN 0 THEN 'price' ELSE 'date' END),
fused AS (SELECT qid, cand_id, fused, row_number() OVER (PARTITION BY qid ORDER BY round(fused, 12) DESC, first, first_rank, cand_id) AS rank FROM t)"""


@query("rrf_fuse", f"{_FUSED} SELECT qid, cand_id, round(fused, 9) AS fused, rank FROM fused")
def rrf_fuse(spark: SparkSession, d: str) -> DataFrame:
    return fusion.rrf(_ranked(spark, d), {"price": 1.0, "date": 1.0}).select("qid", "cand_id", _r("fused", 9), F.col("rank").cast("long").alias("rank"))


def _cut_sql(lists: str, min_k: int, keep: int, least: float, gap: float) -> str:
    return f"""{lists}, l AS (SELECT *, lag(fused) OVER w AS prev, first_value(fused) OVER w AS top, count(*) OVER (PARTITION BY qid) AS n FROM fused WINDOW w AS (PARTITION BY qid ORDER BY rank)),
e AS (SELECT *, max(CASE WHEN rank > {max(min_k, 1)} AND (fused < {least} OR ((prev - fused) / prev > {gap} AND fused < 0.3 * top)) THEN 1 ELSE 0 END) OVER (PARTITION BY qid ORDER BY rank ROWS UNBOUNDED PRECEDING) AS ended FROM l)
SELECT qid, cand_id, round(fused, 9) AS fused, rank FROM e WHERE n <= {min_k} OR rank <= {max(min_k, keep)} OR (rank > {max(min_k, 1)} AND rank <= 30 AND ended = 0 AND top > 0)"""


@query("adaptive_k", _cut_sql(_FUSED, 0, 0, 0.001, 0.15))
def adaptive_k(spark: SparkSession, d: str) -> DataFrame:
    fused = fusion.rrf(_ranked(spark, d), {"price": 1.0, "date": 1.0})
    return fusion.adaptive_k(fused).select("qid", "cand_id", _r("fused", 9), F.col("rank").cast("long").alias("rank"))


_PRICES = "WITH fused AS (SELECT o_custkey AS qid, o_orderkey AS cand_id, o_totalprice / 500000 AS fused, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)"


@query("adaptive_k_keep_top1", _cut_sql(_PRICES, 0, 1, 0.05, 0.15))
def adaptive_k_keep_top1(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("cand_id"), (F.col("o_totalprice") / 500000).alias("fused"), "o_totalprice")
    lists = o.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("o_totalprice"), "cand_id"))).drop("o_totalprice")
    return fusion.adaptive_k(lists, min_score=0.05, keep_top1=True).select("qid", "cand_id", _r("fused", 9), F.col("rank").cast("long").alias("rank"))


@query("retrieval_features", f"""
WITH k AS ({_RANKED}), p AS (SELECT DISTINCT o_custkey AS s1_id, o_orderkey AS cand_id FROM orders)
SELECT s1_id, p.cand_id, coalesce(a.rank, 999) AS retrieval_price_rank, coalesce(a.score, 0) AS retrieval_price_score, CAST(a.rank IS NOT NULL AS DOUBLE) AS retrieval_price_found,
  coalesce(b.rank, 999) AS retrieval_date_rank, coalesce(b.score, 0) AS retrieval_date_score, CAST(b.rank IS NOT NULL AS DOUBLE) AS retrieval_date_found,
  CAST(a.rank IS NOT NULL AS BIGINT) + CAST(b.rank IS NOT NULL AS BIGINT) AS retrieval_found_in_n
FROM p LEFT JOIN k a ON a.retriever = 'price' AND a.qid = s1_id AND a.cand_id = p.cand_id LEFT JOIN k b ON b.retriever = 'date' AND b.qid = s1_id AND b.cand_id = p.cand_id""")
def retrieval_features(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "orders").select(F.col("o_custkey").alias("s1_id"), F.col("o_orderkey").alias("cand_id")).distinct()
    got = features.retrieval_features(pairs, _ranked(spark, d), ["price", "date"])
    return got.withColumns({c: F.col(c).cast("long") for c in ("retrieval_price_rank", "retrieval_date_rank", "retrieval_found_in_n")})


@query("pair_features")
def pair_features(spark: SparkSession, d: str) -> DataFrame:
    s1, pool = (text.normalise(df) for df in _records(spark, d))
    return features.pair_features(_sql(spark, d, _LINKS, "supplier", "customer", "part"), s1, pool)


# ---- negatives

@query("collision_negatives", """
WITH p AS (SELECT p_partkey AS k, p_name AS n, p_type AS a FROM part), x AS (SELECT a.k AS s1, b.k AS c, CASE WHEN a.n = b.n THEN 0 ELSE 1 END AS kind FROM p a JOIN p b ON (a.n = b.n OR a.a = b.a) AND a.k <> b.k)
SELECT concat('A', s1) AS s1_id, concat('B', c) AS cand_id FROM (SELECT *, row_number() OVER (ORDER BY concat('A', s1), kind, concat('B', c)) AS nth FROM x)
WHERE nth <= (SELECT floor(floor(count(*) * CAST(3.0 AS DOUBLE)) * CAST(0.2 AS DOUBLE)) FROM p)""")
def collision_negatives(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    side = lambda x: p.select(F.concat(F.lit(x), "p_partkey").alias("entity_id"), F.col("p_name").alias("name_clean"), F.col("p_type").alias("addr_clean"))
    same = p.select(F.concat(F.lit("A"), "p_partkey").alias("s1_id"), F.concat(F.lit("B"), "p_partkey").alias("cand_id"))
    return negatives.collision_negatives(side("A"), side("B"), same, negatives.limits(same, Settings().neg_ratio)[2])


@query("retrieval_negatives", f"""
WITH s AS ({_SCORED}), t AS ({_TRUE_PAIRS})
SELECT s1_id, cand_id FROM s ANTI JOIN t USING (s1_id, cand_id) ORDER BY round(score, 9) DESC, s1_id, cand_id
LIMIT (SELECT CAST(floor(floor(count(*) * CAST(3.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)) AS BIGINT) FROM t)""")
def retrieval_negatives(spark: SparkSession, d: str) -> DataFrame:
    true = _sql(spark, d, _TRUE_PAIRS, "lineitem")
    return negatives.retrieval_negatives(_scored(spark, d), true, negatives.limits(true, Settings().neg_ratio)[1])


@query("training_pairs")
def training_pairs(spark: SparkSession, d: str) -> DataFrame:
    s1, pool = (cut(_named(df), "records") for df in _records(spark, d))
    got = lexical.tfidf_topk(lexical.fit_tfidf(pool), s1, Settings().top_k).select(F.col("qid").alias("s1_id"), "cand_id", "score")
    return negatives.training_pairs(s1, pool, _truth(spark, d), got)


# ---- decision and evaluation

_CLAIMED = f"""
WITH s AS ({_SCORED}), b AS (SELECT *, max(score) OVER (PARTITION BY s1_id) AS best FROM s),
c AS (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY best DESC, s1_pos) AS nth FROM b WHERE best >= 0.3 AND score >= 0.5),
m AS (SELECT s1_id, cand_id, score FROM c WHERE nth = 1)"""


@query("decide_one_to_one", f"{_CLAIMED} SELECT s1_id, cand_id, round(score, 6) AS score FROM m")
def decide_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    return decision.decide(_scored(spark, d)).select("s1_id", "cand_id", _r("score"))


_PER = f"""{_CLAIMED}, t AS ({_TRUE_PAIRS}), i AS (SELECT s_suppkey AS s1_id FROM supplier),
e AS (SELECT s1_id, (SELECT count(*) FROM m WHERE m.s1_id = i.s1_id) AS n_pred, (SELECT count(*) FROM t WHERE t.s1_id = i.s1_id) AS n_true, (SELECT count(*) FROM m JOIN t USING (s1_id, cand_id) WHERE m.s1_id = i.s1_id) AS tp FROM i),
f AS (SELECT *, CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0 WHEN n_pred = 0 OR n_true = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * tp / n_pred + tp / n_true) END AS f05,
  CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0 WHEN n_pred = 0 OR n_true = 0 THEN 0.0 ELSE tp / n_pred END AS p, CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0 WHEN n_pred = 0 OR n_true = 0 THEN 0.0 ELSE tp / n_true END AS r FROM e)"""


def _pred(spark: SparkSession, d: str) -> DataFrame:
    by = decision.decide(_scored(spark, d)).groupBy("s1_id").agg(F.collect_list("cand_id").alias("matches"))
    return by


def _entities(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    to = lambda df: df.withColumn("matches", F.col("matches").cast("array<string>"))
    return to(_pred(spark, d)), to(_pair_truth(spark, d))


@query("entity_f05", f"{_PER} SELECT s1_id, tp, n_pred - tp AS fp, n_true - tp AS fn, round(f05, 6) AS f05 FROM f")
def entity_f05(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.entity_scores(*_entities(spark, d)).select("s1_id", *[F.col(c).cast("long").alias(c) for c in ("tp", "fp", "fn")], _r("f05"))


@query("eval_summary", f"""{_PER} SELECT round(avg(f05), 6) AS macro_f05, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall,
  round(sum(tp) / sum(n_pred), 6) AS micro_precision, round(sum(tp) / sum(n_true), 6) AS micro_recall,
  CAST(sum(tp) AS BIGINT) AS total_tp, CAST(sum(n_pred - tp) AS BIGINT) AS total_fp, CAST(sum(n_true - tp) AS BIGINT) AS total_fn, count(*) AS n_entities,
  CASE WHEN count(*) FILTER (n_pred = 0) > 0 THEN round(count(*) FILTER (n_pred = 0 AND n_true = 0) / count(*) FILTER (n_pred = 0), 6) ELSE 0.0 END AS singleton_precision FROM f""")
def eval_summary(spark: SparkSession, d: str) -> DataFrame:
    e = evaluate.evaluate(*_entities(spark, d))
    return e.select(*[_r(c) for c in ("macro_f05", "macro_precision", "macro_recall", "micro_precision", "micro_recall")], "total_tp", "total_fp", "total_fn", "n_entities", _r("singleton_precision"))


@query("calibrate_grid", f"""
WITH g AS (SELECT i, 0.1 + i * ((0.9 - 0.1) / 49) AS t FROM range(50) x(i)), s AS ({_SCORED}), b AS (SELECT *, max(score) OVER (PARTITION BY s1_id) AS best FROM s),
c AS (SELECT i, s1_id, cand_id, row_number() OVER (PARTITION BY i, cand_id ORDER BY best DESC, s1_pos) AS nth FROM b JOIN g ON score >= t WHERE best >= 0.3),
t AS ({_TRUE_PAIRS}), n AS (SELECT s_suppkey AS s1_id, count(t.cand_id) AS n_true FROM supplier LEFT JOIN t ON t.s1_id = s_suppkey GROUP BY s_suppkey),
p AS (SELECT i, c.s1_id, count(*) AS n_pred, count(t.cand_id) AS tp FROM c LEFT JOIN t ON t.s1_id = c.s1_id AND t.cand_id = c.cand_id WHERE nth = 1 GROUP BY i, c.s1_id),
f AS (SELECT g.i, g.t, CASE WHEN p.n_pred IS NULL AND n_true = 0 THEN 1.0 WHEN p.n_pred IS NULL OR n_true = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * tp / n_pred + tp / n_true) END AS f
  FROM g CROSS JOIN n LEFT JOIN p ON p.i = g.i AND p.s1_id = n.s1_id)
SELECT i, round(t, 6) AS t, round(avg(f), 6) AS macro_f05 FROM f GROUP BY i, t""")
def calibrate_grid(spark: SparkSession, d: str) -> DataFrame:
    got = decision.threshold_scores(_scored(spark, d), _pair_truth(spark, d), decision.grid(spark, 0.1, 0.9, 50), decision.SINGLETON)
    return got.select(F.col("i").cast("long").alias("i"), _r("t"), _r("macro_f05"))


@query("blocking_quality", f"""
WITH c AS (SELECT DISTINCT s1_id, cand_id FROM ({_SCORED}) WHERE score >= 0.6), t AS ({_TRUE_PAIRS}),
e AS (SELECT s_suppkey, (SELECT count(*) FROM c WHERE c.s1_id = s_suppkey) AS n, (SELECT count(*) FROM t WHERE t.s1_id = s_suppkey) AS n_true, (SELECT count(*) FROM c JOIN t USING (s1_id, cand_id) WHERE c.s1_id = s_suppkey) AS hits FROM supplier)
SELECT round(sum(hits) / sum(n_true), 6) AS recall_ceiling, CAST(sum(n_true) AS BIGINT) AS total_true_matches, CAST(sum(n) AS BIGINT) AS total_candidates, round(avg(n), 6) AS mean_candidates,
  round(quantile_cont(n, 0.5), 6) AS median_candidates, round(quantile_cont(n, 0.95), 6) AS p95_candidates, max(n) AS max_candidates, count(*) FILTER (n_true > 0 AND hits = 0) AS missed_entities,
  round(count(*) FILTER (n_true > 0 AND hits = 0) / count(*) * 100, 6) AS missed_entity_pct FROM e""")
def blocking_quality(spark: SparkSession, d: str) -> DataFrame:
    got = evaluate.blocking_quality(_scored(spark, d).where("score >= 0.6").select(F.col("s1_id").alias("qid"), "cand_id"), _pair_truth(spark, d))
    return got.select(_r("recall_ceiling"), "total_true_matches", "total_candidates", *[_r(c) for c in ("mean_candidates", "median_candidates", "p95_candidates")], "max_candidates", "missed_entities", _r("missed_entity_pct"))


@query("match_lists", f"""{_CLAIMED} SELECT s_suppkey AS s1_id, coalesce(string_agg(CAST(cand_id AS VARCHAR), ',' ORDER BY score DESC, cand_id), '') AS matches FROM supplier LEFT JOIN m ON m.s1_id = s_suppkey GROUP BY s_suppkey""")
def match_lists(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "supplier").select(F.col("s_suppkey").alias("s1_id"))
    got = decision.with_singletons(decision.decide(_scored(spark, d)), ids)
    return got.select("s1_id", F.array_join("matches", ",").alias("matches"))


# ---- profiles

_TRUTH_N = f"SELECT concat('S1-', s_suppkey) AS s1_id, count(l.cand_id) AS n, count(l.cand_id) FILTER (l.cand_id LIKE 'S2-%') AS n2, count(l.cand_id) FILTER (l.cand_id LIKE 'S3-%') AS n3 FROM supplier LEFT JOIN ({_LINKS}) l ON l.s1_id = concat('S1-', s_suppkey) GROUP BY s_suppkey"


@query("country_counts", f"SELECT country, count(*) AS n FROM ({_ALL}) GROUP BY country")
def country_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.country_counts(_everything(spark, d))


@query("reverse_truth", f"SELECT cand_id, string_agg(s1_id, ',' ORDER BY s1_id) AS s1_ids FROM ({_LINKS}) GROUP BY cand_id")
def reverse_truth(spark: SparkSession, d: str) -> DataFrame:
    return profile.reverse_truth(_truth(spark, d)).select("cand_id", F.array_join("s1_ids", ",").alias("s1_ids"))


@query("multi_match_check", f"SELECT cand_id, count(*) AS n FROM ({_TRUE_PAIRS}) GROUP BY cand_id HAVING count(*) > 1")
def multi_match_check(spark: SparkSession, d: str) -> DataFrame:
    return profile.multi_matched(_pair_truth(spark, d))


@query("match_histogram", f"SELECT n AS n_matches, count(*) AS n_records, round(count(*) * 100 / (SELECT count(*) FROM supplier), 6) AS percent FROM ({_TRUTH_N}) GROUP BY n")
def match_histogram(spark: SparkSession, d: str) -> DataFrame:
    return profile.match_histogram(_truth(spark, d)).select("n_matches", "n_records", _r("percent"))


@query("match_summary", f"SELECT count(*) AS n_records, count(*) FILTER (n = 0) AS singletons, round(avg(n), 6) AS mean_matches, max(n) AS max_matches FROM ({_TRUTH_N})")
def match_summary(spark: SparkSession, d: str) -> DataFrame:
    return profile.match_summary(_truth(spark, d)).select("n_records", "singletons", _r("mean_matches"), "max_matches")


@query("source_histogram", f"SELECT 'S2' AS source, n2 AS n_matches, count(*) AS n_records FROM ({_TRUTH_N}) GROUP BY n2 UNION ALL SELECT 'S3', n3, count(*) FROM ({_TRUTH_N}) GROUP BY n3")
def source_histogram(spark: SparkSession, d: str) -> DataFrame:
    return profile.source_histogram(_truth(spark, d))


_AUDIT = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, count(*) FILTER (trim({c}) = '') AS n_blank, count(*) AS n_rows FROM documents" for c in ("text", "lang", "source"))


@query("missing_audit", _AUDIT)
def missing_audit(spark: SparkSession, d: str) -> DataFrame:
    return profile.missing_audit(table(spark, d, "documents"))


_LENGTHS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(length(coalesce({c}, ''))), 6) AS mean_length, round(quantile_cont(length(coalesce({c}, '')), 0.5), 6) AS median_length, min(length(coalesce({c}, ''))) AS min_length, max(length(coalesce({c}, ''))) AS max_length FROM documents"
    for c in ("text", "lang", "source")
)


@query("length_stats", _LENGTHS)
def length_stats(spark: SparkSession, d: str) -> DataFrame:
    got = profile.length_stats(table(spark, d, "documents"), ["text", "lang", "source"])
    return got.select("column", _r("mean_length"), _r("median_length"), "min_length", "max_length")


@query("sample_pairs", f"""
WITH l AS ({_LINKS}), f AS (SELECT DISTINCT s1_id FROM l ORDER BY s1_id LIMIT 15), r AS (SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY cand_id) - 1 AS pos FROM l JOIN f USING (s1_id))
SELECT r.s1_id, pos, cand_id, a.business_name AS s1_name, b.business_name AS cand_name FROM r JOIN ({_S1}) a ON a.entity_id = r.s1_id JOIN ({_S2} UNION ALL {_S3}) b ON b.entity_id = cand_id WHERE pos < 3""")
def sample_pairs(spark: SparkSession, d: str) -> DataFrame:
    return profile.sample_matches(_truth(spark, d), *_records(spark, d)).withColumn("pos", F.col("pos").cast("long"))


@query("stratified_split", f"""
WITH t AS ({_S1}), l AS (SELECT s1_id, count(*) AS n FROM ({_LINKS}) GROUP BY s1_id),
r AS (SELECT entity_id AS s1_id, concat(country, '|', least(coalesce(n, 0), 3)) AS stratum, md5(concat('42:', entity_id)) AS h FROM t LEFT JOIN l ON l.s1_id = entity_id)
SELECT s1_id, row_number() OVER (PARTITION BY stratum ORDER BY h, s1_id) <= round_even(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY stratum), 0) AS is_val FROM r""")
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return profile.stratified_split(_truth(spark, d), _records(spark, d)[0])


@query("stress_corrupt")
def stress_corrupt(spark: SparkSession, d: str) -> DataFrame:
    return text.normalise(stress.corrupt(_everything(spark, d)))


@query("gbt_scores")
def gbt_scores(spark: SparkSession, d: str) -> DataFrame:
    cores = spark.sparkContext.defaultParallelism
    with scratch() as keep:  # only the rows outlive it, so the trees have the disk to themselves
        s1, pool = (cut(text.normalise(df.repartition(cores, "entity_id")), "records") for df in _records(spark, d))
        with scratch() as keep_found:
            got = keep_found(lexical.tfidf_topk(lexical.fit_tfidf(pool), s1, Settings().top_k))
        pairs = negatives.training_pairs(s1, pool, _truth(spark, d), got.select(F.col("qid").alias("s1_id"), "cand_id", "score"))
        parts = profile.stratified_split(_truth(spark, d), s1, Settings().val_fraction).select(F.col("s1_id").alias("v_id"), "is_val")
        rows = features.pair_features(pairs, s1, pool).join(parts, F.col("s1_id") == F.col("v_id")).drop("v_id")
        rows = keep(cut(rows, "features"))
    model = PairMatcher.train(rows.where("not is_val"), rows.where("is_val"), rounds=Settings().rounds)
    return model.score(rows).select("s1_id", "cand_id", "label", _r("score"))
