"""Queries of validation and review: lineitem rows as extractions, with the order as work, its flag as entity and status as attribute."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import gold, validation
from sievework.sources.tables import read

from .registry import query

ATTRIBUTES = [("F", "numeric", "R", 5.0, 45.0, None), ("O", "categorical", None, None, None, "7; 9;11 ;13"), ("X", "numeric", "A", None, 30.0, None)]
_ATTRIBUTES = """attributes(attribute_id, kind, wanted, lowest, highest, accepted) AS (VALUES ('F', 'numeric', 'R', 5.0::DOUBLE, 45.0::DOUBLE, NULL),
    ('O', 'categorical', NULL, NULL, NULL, '7; 9;11 ;13'), ('X', 'numeric', 'A', NULL, 30.0, NULL))"""
_E = """e AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INT) AS extraction_id, l_orderkey AS work_id, l_returnflag AS entity_id, l_linestatus AS attribute_id,
    CASE WHEN l_tax > 0 THEN l_quantity END AS value_num, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS value_cat, l_discount AS confidence, l_returnflag AS unit,
    CASE WHEN l_linestatus = 'F' THEN 'numeric' ELSE 'categorical' END AS kind, CASE WHEN l_tax < 0.07 THEN 'raw' WHEN l_tax < 0.08 THEN 'approved' ELSE 'conflict' END AS status FROM lineitem)"""


def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', CAST(l_quantity AS INT)) AS extraction_id", "l_orderkey AS work_id", "l_returnflag AS entity_id", "l_linestatus AS attribute_id",
        "CASE WHEN l_tax > 0 THEN l_quantity END AS value_num", "CAST(CAST(l_quantity AS INT) AS STRING) AS value_cat", "l_discount AS confidence", "l_returnflag AS unit",
        "CASE WHEN l_linestatus = 'F' THEN 'numeric' ELSE 'categorical' END AS kind",
        "CASE WHEN l_tax < 0.07 THEN 'raw' WHEN l_tax < 0.08 THEN 'approved' ELSE 'conflict' END AS status", "CAST(NULL AS STRING) AS reason",
    )


def attributes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ATTRIBUTES, "attribute_id string, kind string, unit string, lowest double, highest double, accepted string")


_REASON = """CASE WHEN a.kind = 'numeric' AND value_num IS NULL THEN 'number_missing' WHEN a.kind = 'numeric' AND value_num < lowest THEN 'below_minimum'
    WHEN a.kind = 'numeric' AND value_num > highest THEN 'above_maximum' WHEN a.kind = 'numeric' AND lower(unit) <> lower(wanted) THEN 'unit_differs'
    WHEN a.kind = 'categorical' AND NOT list_contains(list_transform(string_split(accepted, ';'), lambda x: trim(x)), value_cat) THEN 'not_in_vocabulary' END"""


@query(f"""WITH {_ATTRIBUTES}, {_E}, r AS (SELECT extraction_id, {_REASON} AS reason FROM e LEFT JOIN attributes a USING (attribute_id))
    SELECT extraction_id, reason, CASE WHEN reason IS NULL OR reason = 'unit_differs' THEN 'raw' ELSE 'rejected' END AS new_status FROM r""")
def plausibility(spark, sf_dir):
    return validation.plausibility(extractions(spark, sf_dir).drop("kind", "reason"), attributes(spark)).select("extraction_id", "reason", "new_status")


@query(f"""WITH {_ATTRIBUTES}, {_E}, r AS (SELECT {_REASON} AS reason FROM e LEFT JOIN attributes a USING (attribute_id)) SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def plausibility_counts(spark, sf_dir):
    return validation.plausibility(extractions(spark, sf_dir).drop("kind", "reason"), attributes(spark)).where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_DIVERGE = """g AS (SELECT work_id, entity_id, attribute_id, count(*) AS n, any_value(kind) AS kind, count(value_num) AS k, max(value_num) - min(value_num) AS spread,
    avg(abs(value_num)) AS size, count(DISTINCT lower(trim(value_cat))) AS kinds FROM {0} GROUP BY 1, 2, 3),
    d AS (SELECT *, CASE WHEN kind = 'numeric' THEN k >= 2 AND spread > 0.05 * size ELSE kinds > 1 END AS diverges FROM g)"""


@query(f"WITH {_E}, {_DIVERGE.format('e')} SELECT work_id, entity_id, attribute_id, n, diverges FROM d")
def values_diverge(spark, sf_dir):
    out = validation.reconcile(extractions(spark, sf_dir))
    return out.groupBy(*validation.KEY).agg(F.count(F.lit(1)).alias("n"), F.bool_or("diverges").alias("diverges"))


_DECIDED = """s AS (SELECT e.*, n, diverges, row_number() OVER (PARTITION BY e.work_id, e.entity_id, e.attribute_id ORDER BY confidence DESC NULLS LAST, extraction_id) AS place
      FROM {0} e JOIN d ON (e.work_id, e.entity_id, e.attribute_id) = (d.work_id, d.entity_id, d.attribute_id)),
    c AS (SELECT *, CASE WHEN n = 1 THEN 'raw' WHEN diverges THEN 'conflict' WHEN place = 1 THEN 'raw' ELSE 'rejected' END AS new_status FROM s)"""


@query(f"""WITH {_E}, {_DIVERGE.format('e')}, {_DECIDED.format('e')} SELECT extraction_id, new_status,
    CASE new_status WHEN 'conflict' THEN 'conflict_within_work' WHEN 'rejected' THEN 'duplicate_within_work' END AS reason FROM c""")
def reconcile(spark, sf_dir):
    return validation.reconcile(extractions(spark, sf_dir)).select("extraction_id", "new_status", "reason")


@query(f"""WITH {_E}, raw AS (SELECT * FROM e WHERE status = 'raw'), {_DIVERGE.format('raw')}, {_DECIDED.format('raw')}
    SELECT e.extraction_id, CASE WHEN new_status <> 'raw' THEN new_status ELSE e.status END AS status,
    CASE new_status WHEN 'conflict' THEN 'conflict_within_work' WHEN 'rejected' THEN 'duplicate_within_work' END AS reason FROM e LEFT JOIN c USING (extraction_id)""")
def reconcile_and_update(spark, sf_dir):
    return validation.reconciled(extractions(spark, sf_dir)).select("extraction_id", "status", "reason")


@query(f"""WITH {_E} SELECT extraction_id, CASE WHEN value_num > 30 THEN 'rejected' ELSE status END AS status, CASE WHEN value_num > 45 THEN 'too_large' END AS reason FROM e""")
def status_update(spark, sf_dir):
    e = extractions(spark, sf_dir)
    decided = e.where("value_num > 30").select("extraction_id", F.lit("rejected").alias("new_status"), F.when(F.col("value_num") > 45, "too_large").alias("reason"))
    return validation.apply_status(e, decided).select("extraction_id", "status", "reason")


def _sources(spark, sf_dir):
    """Part rows as values of a brand (entity) and size; the retail price decides year and doi."""
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS extraction_id", "p_brand AS entity_id", "p_brand AS entity", "CAST(p_size AS STRING) AS attribute_id", "CAST(NULL AS DOUBLE) AS value_num", "split_part(p_type, ' ', 1) AS value_cat",
        "CASE WHEN p_retailprice < 930 THEN concat('see (', p_name, ', 1999)') WHEN p_retailprice < 950 THEN concat('see (Hero et al., ', 1990 + p_size, ')') ELSE p_name END AS evidence",
        "CASE WHEN p_retailprice < 1900 THEN 1950 + p_size + length(p_name) END AS year", "concat('10.1/', p_partkey) AS doi",
        "CASE WHEN p_retailprice < 1000 THEN 'poster' WHEN p_retailprice < 1100 THEN 'article' END AS document_type",
    )


_S = """s AS (SELECT p_partkey AS extraction_id, p_brand AS entity_id, p_size AS attribute_id, split_part(p_type, ' ', 1) AS value_cat,
    CASE WHEN p_retailprice < 930 THEN 'see (' || p_name || ', 1999)' WHEN p_retailprice < 950 THEN 'see (Hero et al., ' || (1990 + p_size) || ')' ELSE p_name END AS evidence,
    CASE WHEN p_retailprice < 1900 THEN 1950 + p_size + length(p_name) END AS year, '10.1/' || p_partkey AS doi,
    CASE WHEN p_retailprice < 1000 THEN 'poster' WHEN p_retailprice < 1100 THEN 'article' END AS document_type FROM part)"""
_COMPILED = """(doi IN ('10.1/7', '10.1/8', '10.1/9', '10.1/123') AND NOT (doi = '10.1/7' AND entity_id IN (SELECT p_brand FROM part WHERE p_partkey = 7)))"""


def _compilations(spark, sf_dir):
    own = read(spark, sf_dir, "part").where("p_partkey = 7").selectExpr("concat('10.1/', p_partkey) AS doi", "concat('Other; ', p_brand) AS own_entities")
    return own.union(spark.createDataFrame([("10.1/8", "Other"), ("10.1/9 ", None), ("10.1/123", "")], "doi string, own_entities string"))


@query(f"WITH {_S} SELECT extraction_id, {_COMPILED} AS compiled FROM s")
def mark_compiled(spark, sf_dir):
    return validation.compiled(_sources(spark, sf_dir), _compilations(spark, sf_dir)).select("extraction_id", "compiled")


@query(f"""WITH {_S}, m AS (SELECT *, {_COMPILED} AS compiled FROM s), p AS (SELECT *, coalesce(document_type, '') <> 'poster' AND NOT compiled AS may,
      regexp_matches(evidence, '\\([A-Z][\\p{{L}}''-]+( et al\\.| & [A-Z][\\p{{L}}''-]+)?,? *\\d{{4}}\\)') AS cites FROM m),
    o AS (SELECT entity_id, attribute_id, value_cat, min(year) AS year, arg_min(doi, (year, doi)) AS doi FROM p WHERE may AND year IS NOT NULL GROUP BY 1, 2, 3),
    f AS (SELECT p.extraction_id, CASE WHEN cites OR compiled OR NOT may THEN 'secondary' WHEN p.year IS NULL THEN NULL WHEN p.year = o.year THEN 'primary' ELSE 'secondary' END AS origin, o.doi
          FROM p LEFT JOIN o ON (p.entity_id, p.attribute_id, p.value_cat) = (o.entity_id, o.attribute_id, o.value_cat))
    SELECT extraction_id, origin, CASE WHEN origin = 'secondary' THEN doi END AS primary_doi FROM f""")
def primary_source(spark, sf_dir):
    marked = validation.compiled(_sources(spark, sf_dir), _compilations(spark, sf_dir))
    return validation.primary_source(marked).select("extraction_id", "origin", "primary_doi")


@query("SELECT p_partkey AS work_id, CASE WHEN p_partkey IN (1, 2, 30) THEN 'poster' WHEN p_size > 25 THEN 'article' END AS document_type FROM part")
def set_document_type(spark, sf_dir):
    works = read(spark, sf_dir, "part").selectExpr("p_partkey AS work_id", "CASE WHEN p_size > 25 THEN 'article' END AS document_type")
    return validation.set_document_type(works, [1, 2, 30], "poster")


def _gold(spark, sf_dir):
    return extractions(spark, sf_dir).where("confidence <= 0.03").select(*validation.KEY, F.when(F.col("kind") == "numeric", F.floor("value_num").cast("string")).otherwise(F.col("value_cat")).alias("value"))


_G = "g AS (SELECT work_id, entity_id, attribute_id, CASE WHEN kind = 'numeric' THEN CAST(CAST(floor(value_num) AS BIGINT) AS VARCHAR) ELSE value_cat END AS value FROM e WHERE confidence <= 0.03)"
_CURVE = f"""{_G}, a AS (SELECT work_id, entity_id, attribute_id, min(value) AS truth FROM g GROUP BY 1, 2, 3 HAVING count(DISTINCT value) = 1),
    p AS (SELECT e.attribute_id, confidence * 10 AS confidence, CASE WHEN kind = 'numeric' THEN abs(value_num - TRY_CAST(truth AS DOUBLE)) <= 0.05 * abs(TRY_CAST(truth AS DOUBLE)) ELSE lower(value_cat) = lower(truth) END AS hit
          FROM e JOIN a USING (work_id, entity_id, attribute_id) WHERE status NOT IN ('rejected', 'conflict')),
    t AS (SELECT 0.05::DOUBLE + i * 0.05::DOUBLE AS threshold FROM range(19) r(i)),
    c AS (SELECT attribute_id, threshold, count(*) AS n_gold, avg(CASE WHEN confidence >= threshold THEN hit::INT END) AS precision, count(*) FILTER (confidence >= threshold AND hit) / count(*) AS recall FROM p, t GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY attribute_id ORDER BY CASE WHEN precision >= 0.5 THEN 0 ELSE 1 END, CASE WHEN precision >= 0.5 THEN threshold END, precision DESC NULLS LAST, threshold) AS place FROM c)"""
_LIMITS = f"{_CURVE}, l AS (SELECT attribute_id, threshold, precision, recall, n_gold, CASE WHEN precision >= 0.5 THEN 'automatic' ELSE 'full_review' END AS decision FROM k WHERE place = 1)"


def _limits(spark, sf_dir):
    return validation.thresholds(extractions(spark, sf_dir).withColumn("confidence", F.col("confidence") * 10), _gold(spark, sf_dir), 0.5)


@query(f"WITH {_E}, {_LIMITS} SELECT attribute_id, round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, n_gold, decision FROM l")
def calibrate_thresholds(spark, sf_dir):
    return _limits(spark, sf_dir).select("attribute_id", *[F.round(c, 6).alias(c) for c in ("threshold", "precision", "recall")], "n_gold", "decision")


@query(f"""WITH {_E}, {_LIMITS} SELECT extraction_id, CASE WHEN status = 'raw' AND decision = 'automatic' AND confidence >= threshold THEN 'approved' ELSE status END AS status FROM e LEFT JOIN l USING (attribute_id)""")
def apply_thresholds(spark, sf_dir):
    return validation.apply_thresholds(extractions(spark, sf_dir), _limits(spark, sf_dir)).select("extraction_id", "status")


@query(f"""WITH {_E}, g2 AS (SELECT work_id, entity_id, attribute_id, any_value(kind) AS kind, count(*) AS n, min(value_cat) AS a, max(value_cat) AS b FROM e GROUP BY 1, 2, 3 HAVING count(*) = 2),
    s AS (SELECT attribute_id, CASE WHEN kind = 'categorical' THEN lower(a) = lower(b) ELSE abs(a::DOUBLE - b::DOUBLE) <= 0.05 * (abs(a::DOUBLE) + abs(b::DOUBLE)) / 2 END AS same FROM g2)
    SELECT attribute_id, count(*) AS n, round(avg(same::INT), 6) AS agreement FROM s GROUP BY attribute_id""")
def gold_agreement(spark, sf_dir):
    rows = extractions(spark, sf_dir)
    kinds = spark.createDataFrame([("F", "numeric"), ("O", "categorical")], "attribute_id string, kind string")
    out = gold.agreement(rows.select(*validation.KEY, F.col("value_cat").alias("value")), kinds)
    return out.withColumn("agreement", F.round("agreement", 6))


_DRAW = "sha256(concat_ws('|', '{0}', {1}::VARCHAR))"


@query(f"""WITH w AS (SELECT DISTINCT o_custkey AS work_id FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')),
    s AS (SELECT work_id, row_number() OVER (ORDER BY {_DRAW.format(1, 'work_id')}, work_id) AS k, count(*) OVER () AS n FROM w)
    SELECT work_id, attribute_id, '' AS value, '' AS evidence FROM s, (VALUES ('F'), ('O'), ('X')) a(attribute_id) WHERE k <= greatest(1, floor(n * 0.1))""")
def gold_sheet(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    done = o.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select(F.col("o_custkey").alias("work_id"))
    open_ = o.select(F.col("o_custkey").alias("work_id")).distinct().join(done, "work_id", "left_anti")
    return gold.blank_sheet(gold.sampled(open_, 0.1, 1, "work_id", least=1), attributes(spark))


@query("SELECT l_orderkey AS work_id, l_returnflag AS value, 'one' AS reviewer FROM lineitem WHERE nullif(l_returnflag, 'N') IS NOT NULL")
def gold_import(spark, sf_dir):
    sheet = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS work_id", "CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS value")
    return gold.filled(sheet, "one")


@query(f"""WITH {_E}, {_LIMITS}, au AS (SELECT extraction_id, row_number() OVER (ORDER BY {_DRAW.format(3, 'extraction_id')}, extraction_id) AS k, count(*) OVER () AS n FROM e WHERE status = 'approved')
    SELECT extraction_id, 'below_threshold' AS queue FROM e LEFT JOIN l USING (attribute_id) WHERE status = 'raw' AND (threshold IS NULL OR confidence < threshold OR decision = 'full_review')
    UNION ALL SELECT extraction_id, 'conflict' FROM e WHERE status = 'conflict' UNION ALL SELECT extraction_id, 'audit' FROM au WHERE k <= floor(n * 0.05)""")
def review_queue(spark, sf_dir):
    return gold.review_queue(extractions(spark, sf_dir), _limits(spark, sf_dir), 0.05, 3).select("extraction_id", "queue")


def _reviews(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").where("l_discount >= 0.05").selectExpr(
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', CAST(l_quantity AS INT)) AS extraction_id", "l_returnflag AS reviewer", "l_shipdate AS at",
        "CASE WHEN l_discount < 0.07 THEN 'ok' WHEN l_discount < 0.09 THEN 'wrong' WHEN l_discount < 0.1 THEN 'ambiguous' ELSE '?' END AS verdict",
        "CASE WHEN l_quantity < 10 THEN l_linestatus WHEN l_quantity < 20 THEN '' END AS corrected")


@query(f"""WITH {_E} SELECT extraction_id, CASE WHEN confidence >= 0.05 AND confidence < 0.07 THEN 'approved' WHEN confidence >= 0.07 AND confidence < 0.09 THEN 'rejected' ELSE status END AS status,
    CASE WHEN confidence >= 0.07 AND confidence < 0.09 THEN 'human_review' END AS reason FROM e""")
def review_verdicts(spark, sf_dir):
    last = _reviews(spark, sf_dir).where("verdict <> '?'")
    earlier = last.withColumns({"verdict": F.lit("wrong"), "at": F.col("at") - F.expr("INTERVAL 1 DAY")})
    return gold.apply_verdicts(extractions(spark, sf_dir), last.union(earlier)).select("extraction_id", "status", "reason")


@query(f"""WITH {_E} SELECT o_orderstatus AS text, attribute_id, CASE WHEN l_quantity < 10 THEN l_linestatus ELSE value_cat END AS label, CASE WHEN l_discount < 0.07 THEN 'ok' ELSE 'wrong' END AS verdict
    FROM e JOIN lineitem ON extraction_id = l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INT) JOIN orders ON o_orderkey = work_id WHERE l_discount >= 0.05 AND l_discount < 0.09""")
def training_export(spark, sf_dir):
    chunks = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS chunk_id", "o_orderstatus AS text")
    return gold.training_rows(_reviews(spark, sf_dir).drop("reviewer", "at"), extractions(spark, sf_dir).withColumn("chunk_id", F.col("work_id")), chunks)


@query("SELECT c_name AS entity, count(*) FILTER (o_orderstatus IN ('F', 'P')) AS with_data, count(*) AS wanted FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name")
def coverage(spark, sf_dir):
    targets = read(spark, sf_dir, "customer").selectExpr("c_custkey AS entity_id", "c_name AS entity")
    pairs = read(spark, sf_dir, "orders").selectExpr("o_custkey AS entity_id", "o_orderstatus AS state")
    return gold.coverage(targets, pairs, ("F", "P"))


@query("""WITH a AS (SELECT quality = 1 AS truth, CASE WHEN n_chars > 100 THEN toxic = 0 END AS answer FROM labels JOIN documents USING (doc_id)),
    c AS (SELECT count(*) FILTER (truth AND answer) AS tp, count(*) FILTER (NOT truth AND answer) AS fp, count(*) FILTER (NOT truth AND NOT answer) AS tn, count(*) FILTER (truth AND NOT answer) AS fn, count(*) FILTER (answer IS NULL) AS unanswered FROM a)
    SELECT *, round(tp / (tp + fn), 6) AS sensitivity, round(tn / (tn + fp), 6) AS specificity FROM c""")
def triage_against_gold(spark, sf_dir):
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    answers = rows.select((F.col("quality") == 1).alias("truth"), F.when(F.col("n_chars") > 100, F.col("toxic") == 0).alias("answer"))
    out = gold.confusion_counts(answers, "truth", "answer")
    return out.withColumns({c: F.round(c, 6) for c in ("sensitivity", "specificity")})


@query(f"""WITH i AS (SELECT doc_id, lang, count(*) OVER (PARTITION BY lang) AS g, count(*) OVER () AS n, row_number() OVER (PARTITION BY lang ORDER BY {_DRAW.format(7, 'doc_id')}, doc_id) AS k FROM documents)
    SELECT doc_id, lang FROM i WHERE k <= greatest(least(4, g), round_even(25 * g / n, 0))""")
def stratified_sample(spark, sf_dir):
    return gold.stratified(read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", 25, 4, 7, "doc_id")


@query(f"""WITH {_E} SELECT extraction_id, 'conflict' AS queue, entity_id, '' AS verdict, '' AS corrected FROM e WHERE status = 'conflict'""")
def review_sheet(spark, sf_dir):
    queue = extractions(spark, sf_dir).where("status = 'conflict'").withColumn("queue", F.lit("conflict"))
    return gold.review_sheet(queue).select("extraction_id", "queue", "entity_id", "verdict", "corrected")


@query(f"""WITH {_E}, {_LIMITS}, g2 AS (SELECT work_id, entity_id, attribute_id, any_value(kind) AS kind, min(value_cat) AS a, max(value_cat) AS b FROM e GROUP BY 1, 2, 3 HAVING count(*) = 2),
    sm AS (SELECT attribute_id, CASE WHEN kind = 'categorical' THEN lower(a) = lower(b) ELSE abs(a::DOUBLE - b::DOUBLE) <= 0.05 * (abs(a::DOUBLE) + abs(b::DOUBLE)) / 2 END AS same FROM g2), ag AS (SELECT attribute_id, count(*) AS n, avg(same::INT) AS agreement FROM sm GROUP BY 1)
    SELECT (SELECT count(*) FROM l WHERE decision = 'automatic') AS automatic, (SELECT count(*) FROM l WHERE decision = 'full_review') AS full_review, (SELECT round(avg(agreement), 6) FROM ag) AS agreement, (SELECT sum(n)::BIGINT FROM ag) AS n_gold_pairs,
    (SELECT round(count(*) FILTER (o_orderstatus IN ('F', 'P')) / count(*), 6) FROM customer JOIN orders ON c_custkey = o_custkey) AS coverage""")
def release_metrics(spark, sf_dir):
    kinds = spark.createDataFrame([("F", "numeric"), ("O", "categorical")], "attribute_id string, kind string")
    agreed = gold.agreement(extractions(spark, sf_dir).select(*validation.KEY, F.col("value_cat").alias("value")), kinds)
    out = gold.metrics(_limits(spark, sf_dir), agreed, coverage(spark, sf_dir))
    return out.select("automatic", "full_review", F.round("agreement", 6).alias("agreement"), "n_gold_pairs", F.round("coverage", 6).alias("coverage"))


@query(f"""WITH {_E}, {_LIMITS}, g2 AS (SELECT work_id, entity_id, attribute_id, any_value(kind) AS kind, min(value_cat) AS a, max(value_cat) AS b FROM e GROUP BY 1, 2, 3 HAVING count(*) = 2),
    sm AS (SELECT attribute_id, CASE WHEN kind = 'categorical' THEN lower(a) = lower(b) ELSE abs(a::DOUBLE - b::DOUBLE) <= 0.05 * (abs(a::DOUBLE) + abs(b::DOUBLE)) / 2 END AS same FROM g2), ag AS (SELECT attribute_id, count(*) AS n, avg(same::INT) AS agreement FROM sm GROUP BY 1)
    SELECT attribute_id, threshold, decision, n, round(agreement, 6) AS agreement FROM l FULL JOIN ag USING (attribute_id)""")
def attribute_metrics(spark, sf_dir):
    kinds = spark.createDataFrame([("F", "numeric"), ("O", "categorical")], "attribute_id string, kind string")
    agreed = gold.agreement(extractions(spark, sf_dir).select(*validation.KEY, F.col("value_cat").alias("value")), kinds)
    return gold.attribute_metrics(_limits(spark, sf_dir), agreed).select("attribute_id", "threshold", "decision", "n", F.round("agreement", 6).alias("agreement"))


@query("""WITH c AS (SELECT c_name, count(*) FILTER (o_orderstatus IN ('F', 'P')) AS with_data FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1)
    SELECT min(with_data) AS least, quantile_cont(with_data, 0.25) AS first_quartile, quantile_cont(with_data, 0.5) AS median, round(avg(with_data), 6) AS mean, quantile_cont(with_data, 0.75) AS third_quartile, max(with_data) AS most FROM c""")
def coverage_summary(spark, sf_dir):
    return gold.coverage_summary(coverage(spark, sf_dir)).withColumn("mean", F.round("mean", 6))
