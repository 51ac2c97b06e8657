"""Queries of what is learned from the tables, and of workbooks."""

from pyspark.sql import functions as F

from sievework.operators import classifiers, languages
from sievework.sources import workbooks
from sievework.sources.tables import read, scratch, until_exit

from .registry import query


@query(rf"""WITH t AS (SELECT doc_id, lang, ' ' || trim(regexp_replace(lower(substr(text, 1, {languages.FIRST})), '[^\p{{L}}]+', ' ', 'g')) || ' ' AS s FROM documents),
    g AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) AS g FROM t WHERE trim(s) <> ''), c AS (SELECT lang, g, count(*) AS n FROM g WHERE doc_id % 4 <> 2 AND lang IS NOT NULL GROUP BY 1, 2),
    k AS (SELECT DISTINCT g FROM (SELECT g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, g) AS r FROM c) WHERE r <= {languages.KEPT}), f AS (SELECT l.lang, k.g, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lang FROM c) l CROSS JOIN k LEFT JOIN c ON c.lang = l.lang AND c.g = k.g),
    p AS (SELECT lang, g, ln((n + 1) / (sum(n) OVER (PARTITION BY lang) + (SELECT count(*) FROM k))) AS p FROM f), s AS (SELECT doc_id, p.lang, sum(p) AS s FROM g JOIN p USING (g) GROUP BY 1, 2), b AS (SELECT doc_id, arg_max(lang, s) AS language FROM s GROUP BY 1)
    SELECT doc_id, language FROM documents LEFT JOIN b USING (doc_id)""")
def learned_language(spark, sf_dir):
    """The language of every document, by a model of three quarters of them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return languages.with_language(docs, languages.learned(docs.where("doc_id % 4 <> 2"))).select("doc_id", "language")


@query()
def local_predictions(spark, sf_dir):
    """Two attributes of every document by local classifiers, trained on all labels of three quarters; one of a third has no model."""
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels").where("doc_id % 4 <> 2")
    rows = docs.join(labels.hint("merge"), "doc_id").select("text", F.explode(F.array(*[F.struct(F.lit(c).alias("attribute_id"), F.col(c).cast("string").alias("label")) for c in ("quality", "toxic")])).alias("a")).select("text", "a.*")  # labels grow with the documents
    folder = scratch(spark, "models")
    until_exit(spark, folder)
    classifiers.train(rows, folder).collect()  # a row for each attribute
    return classifiers.predict_each(docs, ["quality", "toxic", "unknown"], folder).select("doc_id", "attribute_id", "class", F.round("prob", 6).alias("prob"))


@query("SELECT p_type AS book, p_partkey::VARCHAR AS k, p_name AS n, p_size::VARCHAR AS s FROM part")
def workbooks_read_back(spark, sf_dir):
    """Workbooks for each type of part, as many as it needs, written by the tasks and read cell by cell."""
    part = read(spark, sf_dir, "part").select("p_type", "p_partkey", "p_name", "p_size")
    folder = scratch(spark, "books")
    until_exit(spark, folder)
    workbooks.write_workbooks(part, "p_type", ["p_partkey"], folder, "parts", workbooks.Look(lists={"p_size": ["1", "2"]}, answer=("p_size",)), numbered=True).collect()  # a row for each book
    cells = workbooks.cells(spark, folder).where("sheet = 'parts' AND row_no > 1")
    rows = cells.groupBy("path", "row_no").agg(*[F.max(F.when(F.col("column_no") == i, F.col("value"))).alias(c) for i, c in enumerate(("k", "n", "s"), 1)])
    return rows.select(F.regexp_extract("path", r"([^/]+)-\d{5}-\d{4}\.xlsx$", 1).alias("book"), "k", "n", "s")
