"""Cases of the findings of round 3 on small tables of their own."""

import os

from sievework.plans.catalogue import ORACLE, QUERIES


def tables(folder, **made) -> str:
    """Parquet tables by name, each from SQL."""
    import duckdb

    for name, sql in made.items():
        duckdb.sql(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


def same_as_sql(spark, folder: str, name: str) -> int:
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    got = QUERIES[name](spark, folder)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = con.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want))
    return len(rows)


def test_a_plain_line_of_two_words_is_no_header(spark, tmp_path):
    text = "'Hyla alba x x x x x x ' || repeat('Hyla alba ', 2) || repeat('word ', 20) || 'Ther bleer'"
    folder = tables(tmp_path, conversations=f"SELECT c AS conv_id, t AS turn, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END AS role, {text} AS text FROM range(18, 22) a(c), range(4) b(t)")
    for name in ("accounts", "account_chunks", "chunks_with_accounts"):
        assert same_as_sql(spark, folder, name)


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_derived_aliases_gather_no_alias_and_an_id_has_the_names_of_all_its_entities(spark):
    from sievework.operators import names

    targets = spark.createDataFrame([(1, "Hyla alba"), (1, "Bufo ater"), (2, "Hyla alba"), (3, "Rana una"), (4, "None such")], "entity_id int, entity string")
    valid = spark.createDataFrame([("Hyla albus",), ("Bufo ater",), ("Rana una",)], "name string")
    synonyms = spark.createDataFrame([("Hyla albus", "Bufo ater var"), ("Hyla albus", "Osteo x"), ("Hyla albus", "Osteo x var"), ("Rana una", "Osteo x"), ("Rana una", "Far off var"), ("Rana una", None), ("Bufo ater", "Bufo old")], "name string, synonym string")
    out = names.derived_aliases(targets, synonyms, valid)
    two, three, many, none = "two words are another valid name", "three words of another name", "alias of several entities", "name not found"
    want = [(1, "Hyla alba", "Bufo ater var", two), (2, "Hyla alba", "Bufo ater var", two), (3, "Rana una", "Far off var", three), (1, "Bufo ater", "Bufo old", None), (4, "None such", None, none)]
    want += [(i, e, "Osteo x", many) for i, e in ((1, "Hyla alba"), (2, "Hyla alba"), (3, "Rana una"))] + [(i, "Hyla alba", a, many if a != "Hyla albus" else two) for i in (1, 2) for a in ("Osteo x var",)]
    got = [tuple(r) for r in out.collect() if r.alias != "Hyla albus"]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert "Window" not in plan_of(out)  # a window over a common alias holds all its rows in one task


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_with_few_attributes_are_not_shuffled_by_them(spark, tmp_path):
    from sievework.operators import gold, validation

    rows = spark.range(100).selectExpr("string(id) AS extraction_id", "concat('a', id % 2) AS attribute_id", "double(id) AS value_num", "'x' AS value_cat", "id / 100 AS confidence", "'mm' AS unit", "'raw' AS status")
    kinds = spark.createDataFrame([("a0", "numeric", "mm", 5.0, 50.0, None)], "attribute_id string, kind string, unit string, lowest double, highest double, accepted string")
    limits = spark.createDataFrame([("a0", 0.5, "automatic")], "attribute_id string, threshold double, decision string")
    out = validation.plausibility(rows, kinds)
    assert out.where("reason = 'above_maximum'").count() == 24 and "hashpartitioning(attribute_id" not in executed(out)
    out = validation.apply_thresholds(rows, limits)
    assert out.where("status = 'approved'").count() == 25 and "hashpartitioning(attribute_id" not in executed(out)
    out = gold.review_queue(rows, limits, 0.1, 3)
    assert out.count() == 75 and "hashpartitioning(attribute_id" not in executed(out)


def test_groups_are_dealt_before_they_are_sorted(spark):
    from sievework.operators import gold, validation

    rows = spark.createDataFrame([(1, "e", "a", "5"), (1, "e", "a", "5.1"), (2, "e", "a", "5"), (2, "e", "a", "7"), (3, "e", "b", "X"), (3, "e", "b", "x"), (4, "e", "b", "x")], "work_id int, entity_id string, attribute_id string, value string")
    kinds = spark.createDataFrame([("a", "numeric"), ("b", "categorical")], "attribute_id string, kind string")
    out = gold.agreement(rows, kinds)
    assert sorted(map(tuple, out.collect())) == [("a", 2, 0.5), ("b", 1, 1.0)]
    assert "REPARTITION_BY_NUM" in executed(out)
    found = rows.selectExpr("work_id", "entity_id", "attribute_id", "'categorical' AS kind", "double(null) AS value_num", "value AS value_cat", "0.5D AS confidence", "concat(work_id, value) AS extraction_id")
    out = validation.reconcile(found)
    assert out.where("diverges").count() == 4 and "REPARTITION_BY_NUM" in executed(out)


def test_ids_within_two_edits_are_found_without_pairs(spark):
    import random

    from sievework.operators import correction

    def edits(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    draw = random.Random(3)
    some = lambda n, most: {"".join(draw.choice("aé,") for _ in range(draw.randint(0, most))) for _ in range(n)}
    near = lambda x: "".join(c for c in x if draw.random() > 0.04) + draw.choice(["", "z", "zz"])
    long = {"".join(draw.choice("abcdefgh") for _ in range(draw.randint(20, 29))) for _ in range(60)}
    good = some(12, 5) | some(25, 8) | long
    bad = (some(60, 8) | {near(x) for x in long}) - good
    every, known = spark.createDataFrame([(x,) for x in bad], "taxonID string"), spark.createDataFrame(list(enumerate(sorted(good))), "g long, good string")
    got: dict = {}
    for r in correction._within_two_edits(every, known).collect():
        low, high = got.get(r.taxonID, (r.low, r.high))
        got[r.taxonID] = min(low, r.low), max(high, r.high)
    hits = {x: [g for g, y in enumerate(sorted(good)) if edits(x, y) <= 2] for x in bad}
    assert got == {x: (min(h), max(h)) for x, h in hits.items() if h} and len({len(x) for x in got}) > 12
    joins = plan_of(correction.repaired_ids(every.selectExpr("taxonID", "'x y' AS scientificName"), known.selectExpr("good AS taxonID", "'n' AS scientificName")))
    assert joins.count("levenshtein(taxonID") == 1 and "(length(good" in joins  # edits are counted for long ids only


def test_a_title_is_compared_once_for_a_reference(spark):
    from sievework.operators import bibliography

    refs = spark.createDataFrame([(1, "The <i>Larva</i> of Hylá &amp; Bufo ß"), (2, None), (3, "other")], "ref_id int, title string")
    cands = spark.createDataFrame([(1, "a", "the larva of hyla bufo ss"), (1, "b", "the larva of hyla bufo ss"), (1, "c", None), (1, "d", None), (1, "e", "The lœrva of hyla & bufo SS"), (2, "f", "x"), (3, "g", "<b>"), (3, "h", "othér"), (3, "i", "ether"), (4, "j", "x")], "ref_id int, cand_id string, cand_title string")
    out = bibliography.title_similarities(refs, cands)
    plain = cands.join(refs, "ref_id").select("cand_id", bibliography.title_similarity("title", "cand_title"))
    got = {r.cand_id: r.similarity for r in out.collect()}
    assert got == dict(map(tuple, plain.collect())) and got["a"] == got["b"] == got["h"] == 1 and got["i"] == 0.8 and got["c"] == got["f"] == got["g"] == 0
    assert "row_number" in plan_of(out)
    refs, cands = refs.selectExpr("*", "2000 AS year", "'x' AS authors"), cands.selectExpr("*", "2000 AS cand_year", "'x' AS surname", "cand_id AS cand_doi")
    best = bibliography.best_candidates(refs, cands)
    assert {r.ref_id: r.cand_id for r in best.collect()} == {1: "a", 2: "f", 3: "h"}


def test_windows_and_sets_are_dealt_and_pairs_are_settled(spark, tmp_path):
    from sievework.operators import pilot, search
    from sievework.plans.relational import _lines

    tables(tmp_path, lineitem="SELECT i // 4 AS l_orderkey, i AS l_partkey, i AS l_suppkey, i % 4 AS l_linenumber FROM range(40) r(i)")
    out = _lines(spark, str(tmp_path))
    assert out.where("n = 4").count() == 10 and "REPARTITION_BY_NUM" in executed(out)
    found = spark.createDataFrame([(1, 1, "a", "x", "s1", "raw"), (1, 1, "a", "x", "s2", "conflict"), (2, 1, "a", "y", "s1", "rejected")], "work_id int, entity_id int, attribute_id string, value_cat string, evidence string, status string")
    out = pilot.corpus_sheet(found, spark.createDataFrame([(1, "E")], "entity_id int, entity string"), spark.createDataFrame([(1, "T", 1990)], "work_id int, title string, year int"))
    assert [(r.model_value, r.evidence, r.block, r.citation) for r in out.collect()] == [("x", "s1 || s2", "1", "T (1990)")] and "REPARTITION_BY_NUM" in executed(out)
    works = spark.createDataFrame([(1, "On Hyla"), (2, "On Bufo"), (3, None)], "work_id int, title string")
    marked = search.named_in_title(works, spark.createDataFrame([(1, 1), (2, 1)], "work_id int, entity_id int"), spark.createDataFrame([(1, ["Hyla"])], "entity_id int, names array<string>"))
    assert {r.work_id: r.named for r in marked.collect()} == {1: True, 2: False, 3: False} and "REPARTITION_BY_NUM" in executed(marked)
    pairs = spark.createDataFrame([(1, i, "a", c, f"s {i % 2}") for i, c in enumerate(["equal", "equal", "differs", "equal"])], "work_id int, entity_id int, attribute_id string, case string, evidence string")
    out = pilot.check_blocks(pairs.dropDuplicates(), 2, 1, 5)
    assert {(r.entity_id, r.block) for r in out.collect()} == {(0, "2"), (1, "2"), (2, "1"), (3, "2")} and "Aggregate [work_id#" not in plan_of(out.where("block = '1'"))


def test_local_classifiers_gather_few_texts_and_read_a_text_once(spark, tmp_path):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from sievework.operators import classifiers

    rows = spark.range(4000).selectExpr("concat('w', id % 1500, if(id % 2 = 0, ' left', ' right')) AS text", "'a' AS attribute_id", "if(id % 2 = 0, 'l', 'r') AS label")
    rows = rows.union(spark.createDataFrame([(None, "a", "l"), ("x", None, "l"), ("x", "a", None), ("y", "b", "l")], "text string, attribute_id string, label string"))
    some = classifiers.drawn(rows, 50)
    order = Window.partitionBy("attribute_id", "label").orderBy(F.xxhash64("text"), "text")
    plain = rows.where("attribute_id IS NOT NULL AND label IS NOT NULL").withColumn("k", F.row_number().over(order)).where("k <= 50").drop("k")
    assert sorted(map(repr, some.collect())) == sorted(map(repr, plain.collect())) and some.count() == 101
    assert "(head#" in plan_of(some) and "last#" in plan_of(some)  # only texts up to the head of a hash are gathered
    classifiers.train(rows, f"{tmp_path}/m").collect()
    texts = spark.createDataFrame([(1, "w1 left"), (2, "w1 right"), (3, None)], "id int, text string")
    each = classifiers.predict_each(texts, ["a", "none"], f"{tmp_path}/m")
    one = classifiers.predict(texts.withColumn("attribute_id", F.explode(F.array(F.lit("a"), F.lit("none")))), f"{tmp_path}/m")
    assert sorted(map(repr, each.collect())) == sorted(map(repr, one.drop("text").collect())) and each.columns == ["id", "attribute_id", "class", "prob"]
    assert "Generate" not in plan_of(QUERIES["local_predictions"](spark, "/root/testdata/sf0.001"))


def test_twins_are_found_among_the_titles_of_the_best(spark):
    from sievework.operators import bibliography

    refs = spark.createDataFrame([(1, "the larva of hyla alba", 2000, "x"), (2, "the larva of hyla alba", None, "x"), (3, "none", 2000, "x"), (4, "one", 2000, "x")], "ref_id int, title string, year int, authors string")
    near, far = "the larva of hyla albo", "the larva of hyla xxxx"
    rows = [(1, "a", refs.first().title, 2000, None), (1, "d", near, 2000, "D"), (1, "c", near, 2000, "C"), (1, "b", near, 2001, "B"), (1, "e", far, 2000, "E"), (2, "f", near, None, None), (2, "g", near, 2000, "G"), (3, "h", None, 2000, None), (3, "i", None, 2000, "I"), (4, "j", "one", 2000, "J"), (4, "k", "one", 2000, "K")]
    cands = spark.createDataFrame([(*r, "x") for r in rows], "ref_id int, cand_id string, cand_title string, cand_year int, cand_doi string, surname string")
    out = bibliography.enriched(refs, cands)
    assert sorted((r.ref_id, r.cand_id, r.cand_doi) for r in out.collect()) == [(1, "a", "C"), (2, "f", None), (3, "h", None), (4, "j", "J")]
    assert out.columns == bibliography.best_candidates(refs, cands).columns
    assert plan_of(QUERIES["resolved_references"](spark, "/root/testdata/sf0.001")).count("Relation [l_orderkey") == 1  # candidates are read once
