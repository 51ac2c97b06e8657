import pytest
from pyspark.sql import functions as F

from sievework.operators import correction, darwin_core, gold, names, pilot, retrieval, runs, search, targets, validation
from sievework.sources import files, providers, sinks
from sievework.streaming.ingest import ingest


def test_patience_and_failure_are_no_answers():
    calls = []

    def fetch(url, params):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("down")
        return 200, {"ok": 1}

    assert providers.patient(fetch, sleep=lambda s: None)("u", {}) == (200, {"ok": 1}) and len(calls) == 3
    with pytest.raises(providers.Unavailable):
        providers.patient(lambda u, p: (503, {}), sleep=lambda s: None)("u", {})
    assert providers.patient(lambda u, p: (404, {}), sleep=lambda s: None)("u", {})[0] == 404


def test_access_tells_errors_from_closed_works():
    def down(url, params):
        raise providers.Unavailable("x")

    assert providers.open_access(lambda u, p: (404, {}), "d") == {"pdf": None, "page": None, "error": None}
    assert providers.open_access(down, "d")["error"] == "x" and providers.doi_exists(down, "d") is None
    assert providers.downloaded(lambda u: b"<html>", "u") is None and providers.downloaded(lambda u: b"xx%PDF-1.4", "u") and providers.downloaded(lambda u: b"", None) is None
    assert providers.structured(lambda b: "<TEI/>", b"") is None and providers.structured(lambda b: "<body/>", b"")
    assert providers.genus_cache(lambda g, p: (200, {"names": [g]}) if g == "A" else down(g, p), ["A", "B"], {"C": []}) == {"C": [], "A": ["A"]}


def test_library_and_candidates():
    assert list(providers.library_records(None, "q", "")) == []
    found = list(providers.library_records(lambda u, p: (200, {"Result": [{"BHLType": "Part", "PartID": 3, "Title": "T", "Date": "1925-1926"}]}), "q", "key"))
    assert found[0]["year"] == 1925 and found[0]["id"] == 3
    assert providers.library_part(lambda u, p: (200, {"Result": [{"Doi": "10.5/X", "Authors": [{"Name": "Lutz, A."}]}]}), "3", "k")["surname"] == "Lutz"

    def fetch(url, params):
        if url == providers.REGISTRY:
            return 200, {"message": {"items": [{"type": "component"}, {"type": "journal-article", "title": ["A title"], "DOI": "10.1/X"}]}}
        assert "," not in params["filter"]
        return 200, {"results": [{"title": "A title", "publication_year": 1990, "authorships": [{"author": {"display_name": "Ana de Sa"}}]}]}

    got = list(providers.candidates_of(fetch, {"ref_id": 1, "title": "A, title: x"}))
    assert [c["cand_id"] for c in got] == ["r0", "w0"] and got[0]["cand_doi"] == "10.1/x" and got[1]["surname"] == "Sa"


def test_run_stops_at_the_limit(spark, tmp_path):
    pending = spark.range(100).selectExpr("id AS work_id", "'e' AS entity_id", "'a' AS attribute_id")
    money = iter([0.5, 1.5, 1.5, 2.5, 2.5, 3.5])
    out = runs.run_pairs(pending, lambda p: p, lambda: next(money), 1.0, f"{tmp_path}/r", at_once=25)
    assert out.stopped and out.usd == 1.5 and 0 < out.pairs < 100 and spark.read.parquet(out.path).count() == out.pairs
    whole = runs.run_pairs(pending, lambda p: p, lambda: 0.0, 1.0, f"{tmp_path}/w", at_once=30)
    assert not whole.stopped and whole.pairs == 100 == spark.read.parquet(whole.path).count()
    assert runs.cost_rows(spark, whole).first().usd == 0.0
    empty = runs.run_pairs(pending.where("false"), lambda p: p, lambda: 0.0, 1.0, f"{tmp_path}/e")
    assert empty.pairs == 0 and not empty.stopped


def test_preflight_and_years(spark):
    a = spark.createDataFrame([("x", "categorical", "closed", "a;b", "term"), ("y", "categorical", "review", "a", "")], "attribute_id string, kind string, status string, accepted string, search_terms string")
    got = {n: ok for n, ok, _ in runs.preflight(a, spark.range(1), files.Settings(), {"up": lambda: True, "down": lambda: (_ for _ in ()).throw(OSError("no"))})}
    assert got == {"targets": True, "search terms": False, "vocabularies": False, "precision": True, "languages": True, "up": True, "down": False}
    assert runs.valid_year(1999.0, 2026) == 1999
    for bad in (None, 1600, 2050, 1999.5, True):
        with pytest.raises((ValueError, TypeError)):
            runs.valid_year(bad, 2026)
    with pytest.raises(ValueError):
        files.Settings.of({"langs": []})


def test_errors_name_what_is_wrong(spark, tmp_path):
    d = spark.createDataFrame([(1, "a", "x")], "row_no long, t string, taxonID string")
    with pytest.raises(ValueError, match="expected"):
        correction.single_cells(d, [(1, "t", "other", "z")])
    with pytest.raises(ValueError, match="no cell"):
        correction.single_cells(d, [(9, "t", "a", "z")])
    with pytest.raises(ValueError, match="kind"):
        targets.checked_attributes(spark.createDataFrame([("a", "n", "text", "u", "t")], "attribute_id string, name string, kind string, unit string, search_terms string"))
    with pytest.raises(ValueError, match="lack"):
        targets.checked_attributes(d)
    works = spark.createDataFrame([("w", None)], "work_id string, document_type string")
    for ids, kind in ((["w"], "book"), (["v"], "poster")):
        with pytest.raises(ValueError):
            validation.set_document_type(works, ids, kind)
    sheet = spark.createDataFrame([("E", "A", "sometimes", None, None)], "entity string, alias string, decision string, work_doi string, note string")
    with pytest.raises(ValueError, match="A"):
        names.decided_aliases(sheet, "R", "1")
    with pytest.raises(ValueError, match="verdict"):
        pilot.adjudicated(works.selectExpr("work_id", "'e' AS entity_id", "'a' AS attribute_id", "'differs' AS case"), works.selectExpr("work_id", "'e' AS entity_id", "'a' AS attribute_id", "'dunno' AS verdict"))
    with pytest.raises(ValueError, match="terms"):
        retrieval.candidates(d, ["x"], [], [" "])
    path = f"{tmp_path}/x.csv"
    assert sinks.write_for_people(d, path) == 1 and open(path, "rb").read().startswith(b"\xef\xbb\xbf")
    with pytest.raises(FileExistsError):
        sinks.write_for_people(d, path)
    assert files.sniffed_csv(spark, path, ("row_no",)).first().t == "a"
    with pytest.raises(ValueError, match="missing"):
        files.sniffed_csv(spark, path, ("none",))
    sinks.write_csv(d, f"{tmp_path}/out")
    with pytest.raises(Exception, match="exists"):
        sinks.write_csv(d, f"{tmp_path}/out")


def test_check_sheet_errors(spark):
    row = lambda **k: spark.createDataFrame([{"id": "R1", "attribute_id": "a", "right_value": "x", "place": "text", "sentence": "yes"} | k], "id string, attribute_id string, right_value string, place string, sentence string")
    accepted = spark.createDataFrame([("a", ["x"])], "attribute_id string, values array<string>")
    assert pilot.checked_sheet(row(), accepted).first().checked and not pilot.checked_sheet(row(right_value=" "), accepted).first().checked
    for bad in (row(right_value="y"), row(place="cellar"), row(sentence="maybe"), row().union(row())):
        with pytest.raises(ValueError):
            pilot.checked_sheet(bad, accepted)


def test_descriptor_and_report(spark, tmp_path):
    import xml.etree.ElementTree as ET

    xml = ET.fromstring(darwin_core.descriptor({"mof": ["taxonID", "measurementValue"], "taxon": ["taxonID", "family"]}, "taxon", "taxonID"))
    assert [e.tag.split("}")[1] for e in xml] == ["core", "extension"] and len(xml.findall(".//{*}field")) == 3
    assert sinks.write_report(f"{tmp_path}/r.json", a=spark.range(2))["a"] == [{"id": 0}, {"id": 1}]
    with pytest.raises(ValueError, match="b has more than 2"):
        sinks.write_report(f"{tmp_path}/no.json", most=2, a=spark.range(2), b=spark.range(3))
    assert not (tmp_path / "no.json").exists()


def test_samples_are_of_the_asked_size(spark):
    rows = spark.range(103).selectExpr("id", "CASE WHEN id < 3 THEN 'a' WHEN id < 33 THEN 'b' ELSE 'c' END AS s")
    assert gold.sampled(rows, 0.1, 1, "id").count() == 10 and gold.sampled(rows.limit(3), 0.1, 1, "id", least=1).count() == 1
    assert {r.id for r in gold.sampled(rows, 0.1, 1, "id").collect()} == {r.id for r in gold.sampled(rows.repartition(5), 0.1, 1, "id").collect()}
    got = {r.s: r["count"] for r in gold.stratified(rows, "s", 25, 4, 1, "id").groupBy("s").count().collect()}
    assert got == {"a": 3, "b": 7, "c": 17}


def test_triage_margin_is_closed(spark):
    rows = [(i, True, p, "w", None) for i, p in enumerate((0.349, 0.35, 0.75, 0.751))] + [(9, None, 0.9, "w", None), (10, True, None, "w", None), (11, True, 0.9, "w", "timeout")]
    got = {r.work_id: (r.relevant, r.decided_by) for r in search.triage_decision(spark.createDataFrame(rows, "work_id long, relevant boolean, prob double, why string, error string"), "m").collect()}
    human, agent = search.HUMAN, "agent:m"
    assert got == {0: (True, agent), 1: (True, human), 2: (True, human), 3: (True, agent), 9: (None, human), 10: (True, human), 11: (None, human)}


def test_stream_adds_each_key_once(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = spark.range(10).selectExpr("id AS k", "id AS v")
    rows.union(rows.limit(3)).coalesce(1).write.parquet(source)
    run = lambda: ingest(spark, source, "k long, v long", target, f"{tmp_path}/state", ["k"]).awaitTermination()
    run()
    spark.range(5, 15).selectExpr("id AS k", "id + 100 AS v").coalesce(1).write.mode("append").parquet(source)
    run()
    got = {r.k: r.v for r in spark.read.parquet(target).collect()}
    assert got == {k: k if k < 10 else k + 100 for k in range(15)} and spark.read.parquet(target).count() == 15


def test_candidates_prefer_accounts_and_keep_a_table(spark):
    long = "the snout is rounded in this account " * 12
    rows = [(1, f"c{i}", i, kind, section, text) for i, (kind, section, text) in enumerate([
        ("text", "Methods", "nothing here"), ("text", None, "Hyla raniceps was seen"), ("text", None, "its snout is round"), ("text", None, "Bufo ictericus is next"), ("text", None, "snout again"),
        ("table", None, "snout values of Hyla raniceps"), *[("text", None, f"Hyla raniceps snout snout snout {i}") for i in range(6)]])]
    rows += [(2, "d0", 0, "account", "Hyla raniceps (Fig. 1)", long), (2, "d1", 1, "text", None, "Hyla raniceps snout"), (3, "e0", 0, "table", None, "snout of another"), (3, "e1", 1, "text", None, "no such name")]
    chunks = spark.createDataFrame(rows, "work_id long, chunk_id string, ord long, kind string, section string, text string")
    got = {}
    for r in retrieval.candidates(chunks, ["Hyla raniceps"], [["Bufo ictericus"]], ["snout"]).collect():
        got.setdefault(r.work_id, {})[r.chunk_id] = r.anchor
    assert set(got[2]) == {"d0"} and set(got[3]) == {"e0"}
    assert len(got[1]) == 4 and "c5" in got[1] and "c4" not in got[1]
    few = {r.chunk_id: r.anchor for r in retrieval.candidates(chunks.where("ord < 5"), ["Hyla raniceps"], [["Bufo ictericus"]], ["snout"]).where("work_id = 1").collect()}
    assert few == {"c2": "Hyla raniceps was seen"}


def test_store_opens_with_all_tables_and_later_columns(spark, tmp_path):
    from sievework.sources import schema

    spark.createDataFrame([("w", "10.1/x")], "work_id string, doi string").write.parquet(f"{tmp_path}/work.parquet")
    tables = schema.opened(spark, str(tmp_path))
    assert set(tables) == set(schema.TABLES) and all(set(keys) <= set(tables[n].columns) for n, (_, keys) in schema.TABLES.items())
    row = tables["work"].first()
    assert row.doi == "10.1/x" and row.document_type is None and tables["chunk"].count() == 0
    assert schema.opened(spark, str(tmp_path))["work"].count() == 1
    assert schema.shaped(spark.createDataFrame([("w", "1999")], "work_id string, year string"), "work").first().year == 1999
    with pytest.raises(ValueError, match="colour"):
        schema.shaped(spark.createDataFrame([("w", "red")], "work_id string, colour string"), "work")


def test_batches_are_priced_before_they_are_sent(spark):
    from sievework.operators import model

    prompts = spark.createDataFrame([("m", "x" * 3500)] * 10, "model string, prompt string")
    prices = spark.createDataFrame([("m", 2.0, 10.0)], "model string, input double, output double")
    assert model.batch_within(prompts, 0, prices, 1.0) == pytest.approx((10 * 1000 * 2 + 10 * 250 * 10) / 1e6 * 0.5)
    with pytest.raises(ValueError, match="limit"):
        model.batch_within(prompts, 0, prices, 0.001)
    with pytest.raises(ValueError, match="price"):
        model.batch_within(prompts.withColumn("model", F.lit("n")), 0, prices, 1.0)


def test_archive_is_written_whole(spark, tmp_path):
    taxonomy = spark.createDataFrame([(2, "t1", "A b", "F", "A"), (3, "t1", "A c", "F", "A")], "row_no long, taxonID string, scientificName string, family string, genus string")
    general = spark.createDataFrame([(2, "t1", "V1", "10.1/x")], "row_no long, taxonID string, collectionCode string, eventID string")
    habitat = spark.createDataFrame([(2, "t1", "pond", None, "e")], "row_no long, taxonID string, Habitat_type string, biome string, eventID string").withColumn("LocationID", F.lit(None).cast("string"))
    morphology = spark.createDataFrame([(2, "t1", "snout", "round\nend", None, "d", "25", "e")], "row_no long, taxonID string, measurementType string, measurementValue string, measurementValue_original string, definition string, stage string, eventID string")
    diet = spark.createDataFrame([(2, "t1", "algae", "12", "%", "3", "e")], "row_no long, taxonID string, measurementType string, measurementAccuracy string, organismQuantity string, organismQuantityType string, eventID string")
    book = {"Taxonomy": taxonomy, "GeneralInformation": general, "Habitat": habitat, "Morphology_DWC": morphology, "Diet_DWC": diet}
    assert darwin_core.migrated(book, str(tmp_path)) == {"taxon": 1, "occurrence": 1, "mof": 3}
    mof = {r.measurementID: r for r in files.tsv(spark, f"{tmp_path}/mof").collect()}
    assert mof["mof2"].measurementValue == "round\nend" and mof["mof3"].measurementType == "diet_item:algae" and "<core" in open(f"{tmp_path}/meta.xml").read()
