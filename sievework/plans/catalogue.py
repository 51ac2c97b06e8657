"""Named queries over the driver's tables, each with SQL that gives the same rows: those below and those of the modules imported here."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import retrieval, review, upsert
from sievework.sources.tables import read

from . import documents, learned, literature, relational, services, sheets, validation  # noqa: F401 (they enter their queries)
from .registry import ORACLE, QUERIES, query

TERMS = ("the", "que", "der")


@query(f"""
    WITH d AS (SELECT doc_id, lang, regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+') AS raw FROM documents),
    t AS (SELECT doc_id, lang, list_filter(raw, lambda x: x <> '') AS tokens FROM d),
    s AS (SELECT count(*) AS n, avg(len(tokens)) AS avgdl FROM t),
    tf AS (SELECT doc_id, lang, len(tokens) AS dl, term, len(list_filter(tokens, lambda x: x = term)) AS tf FROM t, (VALUES {", ".join(f"('{x}')" for x in TERMS)}) q(term)),
    df AS (SELECT term, count(*) AS df FROM tf WHERE tf > 0 GROUP BY term),
    sc AS (SELECT doc_id, lang, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
           FROM tf JOIN df USING (term), s WHERE tf > 0 GROUP BY doc_id, lang),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS rank FROM sc)
    SELECT lang, doc_id, score, rank FROM r WHERE rank <= 5""")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.bm25_topk(read(spark, sf_dir, "documents"), list(TERMS), "lang", 5)


@query("""
    WITH h AS (SELECT conv_id, turn, coalesce(role = 'user', false) AS is_text, coalesce(contains(lower(text), 'the'), false) AS hit,
                      coalesce(contains(lower(text), 'que'), false) AS other FROM conversations),
    e AS (SELECT a.conv_id, a.turn, max(b.turn) AS event FROM h a JOIN h b ON a.conv_id = b.conv_id AND b.turn < a.turn AND b.is_text AND (b.hit OR b.other)
          WHERE a.is_text AND NOT a.hit AND NOT a.other GROUP BY 1, 2),
    n AS (SELECT e.conv_id, e.turn, event, count(*) AS steps FROM e JOIN h b ON b.conv_id = e.conv_id AND b.is_text AND b.turn > event AND b.turn <= e.turn GROUP BY 1, 2, 3)
    SELECT h.conv_id, h.turn, h.hit, h.other, s.turn AS anchor FROM h LEFT JOIN n ON n.conv_id = h.conv_id AND n.turn = h.turn AND steps <= 3
    LEFT JOIN h s ON s.conv_id = h.conv_id AND s.turn = event AND s.hit""")
def anchor_bounded_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lower("text")
    return retrieval.bounded_carry_forward(read(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user", text.contains("the"), text.contains("que"), 3)


def _sizes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old rows and a batch that overlap by size and together hold every part."""
    part = read(spark, sf_dir, "part")
    return part.where("coalesce(p_size, 0) <= 30").select("p_partkey", "p_name"), part.where("p_size > 20").selectExpr("p_partkey", "upper(p_name) AS p_name")


@query("SELECT p_partkey, CASE WHEN p_size > 20 THEN upper(p_name) ELSE p_name END AS p_name FROM part")
def upsert_replace_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.replace(*_sizes(spark, sf_dir), ["p_partkey"])


@query("SELECT p_partkey, CASE WHEN p_size > 30 THEN upper(p_name) ELSE p_name END AS p_name FROM part")
def insert_if_absent_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.insert_absent(*_sizes(spark, sf_dir), ["p_partkey"])


def _repeated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old rows by customer, and a batch of orders that names most customers several times."""
    old = read(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS v", "c_mktsegment AS w").where("w <> 'BUILDING'")
    return old, read(spark, sf_dir, "orders").selectExpr("o_custkey AS k", "concat('o', o_orderkey) AS v", "o_orderkey")


@query("""WITH b AS (SELECT o_custkey AS k, 'o' || max(o_orderkey) AS v FROM orders GROUP BY 1) SELECT k, v, NULL AS w FROM b
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey NOT IN (SELECT k FROM b)""")
def upsert_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.replace(*_repeated(spark, sf_dir), ["k"], "o_orderkey")


@query("""WITH b AS (SELECT o_custkey AS k, 'o' || min(o_orderkey) AS v FROM orders GROUP BY 1), c AS (SELECT c_custkey AS k, c_name AS v, c_mktsegment AS w FROM customer WHERE c_mktsegment <> 'BUILDING')
    SELECT * FROM c UNION ALL SELECT k, v, NULL FROM b WHERE k NOT IN (SELECT k FROM c)""")
def insert_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.insert_absent(*_repeated(spark, sf_dir), ["k"], "o_orderkey")


@query("SELECT c_custkey AS k, c_name AS v, c_mktsegment AS w FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT o_custkey, 'o' || o_orderkey, NULL FROM orders")
def append_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.replace(*_repeated(spark, sf_dir), [])


@query("""WITH o AS (SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_brand END AS p_brand FROM part WHERE p_size <= 30) SELECT o.p_partkey, o.p_name, coalesce(o.p_brand, upper(p.p_brand)) AS p_brand FROM o JOIN part p USING (p_partkey)
    UNION ALL SELECT p_partkey, p_type, upper(p_brand) FROM part WHERE p_size > 30""")
def fill_missing_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    old = part.where("p_size <= 30").selectExpr("p_partkey", "p_name", "CASE WHEN p_size > 10 THEN p_brand END AS p_brand")
    return upsert.fill_missing(old, part.selectExpr("p_partkey", "p_type AS p_name", "upper(p_brand) AS p_brand"), ["p_partkey"], ["p_brand"])


@query("SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN c_mktsegment ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN customer ON c_custkey = o_orderkey")
def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = read(spark, sf_dir, "customer").where("c_acctbal < 5000").selectExpr("c_custkey AS o_orderkey", "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS o_orderstatus")
    return upsert.update(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), changes, ["o_orderkey"])


@query("SELECT p_partkey FROM part WHERE p_brand <> 'Brand#1'")
def delete_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.delete(read(spark, sf_dir, "part"), "p_brand", "Brand#1").select("p_partkey")


@query("SELECT o_orderkey AS work_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_returnflag = 'A'))")
def delete_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS work_id", "l_returnflag AS entity_id")
    return upsert.delete_with_orphans(read(spark, sf_dir, "orders").selectExpr("o_orderkey AS work_id"), links, "A")[0]


@query("SELECT quality AS truth, toxic AS guess, count(*) AS n FROM labels GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.confusion(read(spark, sf_dir, "labels"), "quality", "toxic")


@query("""
    WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS k FROM c) SELECT source, lang, n FROM r WHERE k = 1""")
def language_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.mode(read(spark, sf_dir, "documents"), "source", "lang")
