import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import check_sheet as c
from sievework.operators import pilot
from sievework.sources import workbooks

PAGES = [
    ("w1", 1, "Tadpoles of   Hyla\nalba and others. Larva seen in ponds near the road, many times over."),
    ("w1", 2, "The snout of Boana alba is rounded in lateral view. Boana"),
    ("w1", 3, "alba again; H. alba. Table 4. Measures. The end of a sentence that goes on"),
    ("w1", 4, "to the next page, quite long. Scinax  ruber   10   20   30 values"),
    ("w2", 1, "Nothing is named here, in this text of the second work."),
    ("w2", 2, None),
]
NAMES = [("w1", "e1", "Rana alba", 0), ("w1", "e1", "Hyla alba", 1), ("w1", "e1", "Boana alba", 2), ("w1", "e2", "Scinax ruber", 0), ("w2", "e1", "Hyla alba", 0)]
PAIRS = [
    ("w1", "e1", "snout", "Rana alba", "The snout of Boana alba is rounded in lateral view. || sentence that goes on to the next page, quite long"),
    ("w1", "e1", "eyes", "Rana alba", None),
    ("w1", "e2", "snout", "Scinax ruber", "Scinax  ruber   10   20   30 values"),
    ("w2", "e1", "eyes", "Rana alba", "this is in no text of that work at all"),
]


def frames(spark):
    pages = spark.createDataFrame(PAGES, "work_id string, page int, text string")
    names = spark.createDataFrame(NAMES, "work_id string, entity_id string, name string, place int")
    pairs = spark.createDataFrame(PAIRS, "work_id string, entity_id string, attribute_id string, entity string, evidence string")
    return pages, names, pairs


def test_names_and_pages(spark):
    pages, names, pairs = frames(spark)
    got = {(r.work_id, r.entity_id, r.attribute_id): (r.name_in_article, r.page) for r in c.with_places(pairs, pages, names).collect()}
    assert got == {
        ("w1", "e1", "snout"): ("Boana alba", "2 || 3"),
        ("w1", "e1", "eyes"): ("Boana alba", "name on p. 2"),
        ("w1", "e2", "snout"): ("", "4"),
        ("w2", "e1", "eyes"): (c.NOT_FOUND, ""),
    }


def test_names_equal_brute_force(spark):
    rng = random.Random(2)
    words = ["Hyla", "alba", "Rana", "parva", "the", "of", "  ", "\n"]
    pages = [(f"w{w}", p, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 12)))) for w in range(30) for p in range(rng.randrange(1, 5))]
    names = [(f"w{w}", "e", n, i) for w in range(30) for i, n in enumerate(["Rana parva", "Hyla alba", "parva of"])]
    pairs = [(f"w{w}", "e", "a", rng.choice(["Hyla alba", "the Hyla Rana", "alba alba alba"]), None) for w in range(30)]
    got = {r.work_id: r.name_in_article for r in c.names_in_articles(spark.createDataFrame(pairs, "work_id string, entity_id string, attribute_id string, entity string, evidence string"), spark.createDataFrame(pages, "work_id string, page int, text string"), spark.createDataFrame(names, "work_id string, entity_id string, name string, place int")).collect()}
    for w, _, _, entity, _ in pairs:
        squeezed = [" ".join(t.split()) for x, _, t in pages if x == w]
        text = " ".join(squeezed)
        counts = [(text.count(n), -i, n) for i, n in enumerate(["Rana parva", "Hyla alba", "parva of"]) if n != entity]
        want = "" if entity in text else max(counts)[2] if max(counts)[0] else c.NOT_FOUND
        if "" in squeezed:  # an empty page: the names over its breaks are not told apart here
            continue
        assert got[w] == want, (w, text)


def test_workbook_is_filled_and_read(spark, tmp_path):
    pages, names, pairs = frames(spark)
    compared = pairs.withColumns({"case": F.when(F.col("attribute_id") == "snout", "equal").otherwise("differs"), "citation": F.concat("work_id", F.lit(": A title, (1990)")), "sheet_value": F.lit("x"), "model_value": F.lit("y")})
    rows = c.check_rows(compared, compared.withColumn("case", F.lit("only_model")), pages, names, 25, 1, 5)
    ids = {r.id: (r.work_id, r.entity_id, r.attribute_id, r.block, r.case_ref) for r in rows.collect()}
    assert ids["R001"][:3] == ("w1", "e1", "eyes") and ids["R002"][:4] == ("w1", "e1", "snout", "2") and len(ids) == 4 and ids["R001"][3:] == ("1", "only_model")
    attributes = spark.createDataFrame([("snout", "Snout shape", "round; oval"), ("eyes", "Eyes", None)], "attribute_id string, name string, accepted string")
    path = f"{tmp_path}/check.xlsx"
    assert c.write_check_workbook(path, rows, attributes, ["## Read me", "{n} rows of {n_articles} articles, {n1} and {n2}"]) == {"review": 4}
    d = {r.id: r for r in workbooks.sheet(spark, path, "review").collect()}
    assert d["R002"].attribute == "Snout shape" and d["R002"].file == "w1_A_title_1990.pdf" and d["R001"].situation == "values differ" and d["R001"].page == "name on p. 2"
    lists = workbooks.lists_of(open(path, "rb").read())
    by_cell = {cell: v for (s, cells), v in lists.items() for cell in cells.split(" ")}
    assert by_cell["M2"] == ["not told", "other (see note)"] and by_cell["M3"] == ["round", "oval", "not told", "other (see note)"]
    assert by_cell["N2:N5"] == list(pilot.WHERE) and by_cell["O2:O5"] == list(pilot.RIGHT_SENTENCE)
    note = [r.value for r in workbooks.cells(spark, path).where("sheet = 'READ ME'").orderBy("row_no").collect()]
    assert note == ["Read me", "4 rows of 2 articles, 2 and 2"]
    accepted = spark.createDataFrame([("snout", ["round", "oval"])], "attribute_id string, values array<string>")
    filled = workbooks.sheet(spark, path, "review").withColumns({"right_value": F.when(F.col("id") == "R002", "oval"), "place": F.lit("text")})
    assert {r.id for r in pilot.checked_sheet(filled, accepted).where("checked").collect()} == {"R002"}
    with pytest.raises(FileExistsError):
        c.write_check_workbook(path, rows, attributes, [])


def test_corpus_sheet_with_places(spark):
    pages, names, pairs = frames(spark)
    e = pairs.drop("entity").withColumns({"value_cat": F.lit("round"), "status": F.when(F.col("work_id") == "w2", "rejected").otherwise("raw")})
    targets = spark.createDataFrame([("e1", "Rana alba"), ("e2", "Scinax ruber")], "entity_id string, entity string")
    works = spark.createDataFrame([("w1", "A title", 1990), ("w2", "B", 1991)], "work_id string, title string, year int")
    rows = {r.id: (r.entity_id, r.attribute_id, r.name_in_article, r.case) for r in c.corpus_check_rows(e, targets, works, pages, names).collect()}
    assert rows == {"C001": ("e1", "eyes", "Boana alba", "extracted"), "C002": ("e1", "snout", "Boana alba", "extracted"), "C003": ("e2", "snout", "", "extracted")}
    assert len(c.corpus_check_rows(e, targets, works, pages, names, pairs.where("entity_id = 'e2'")).collect()) == 1
    with pytest.raises(ValueError, match="nothing"):
        c.corpus_check_rows(e.where("status = 'rejected'"), targets, works, pages, names)
