"""Every operator and every pipeline stage on ids beside nulls and over 2^53, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from sievework.llm import ann, automaton, hostrules, htmlmain, jaccard, ordinal, packing, toxicity, urlcascade, wavelet  # noqa: E402
from sievework.llm.queries import URL_RULES  # noqa: E402

BIG = (1 << 60) + 1
WORDS = "these are the plain words of a text that goes on for a while so that it has some shingles of its own"
TEXTS = [WORDS, None, "", "short", WORDS.replace("plain", "other") + " " + "with more words at its end " * 3, "x" * 20_000 + " " + "long words " * 3000]
IDS = [None, BIG, 7, (1 << 53) + 1, None, 8]
#: Columns named as the operators name their own.
CLASH = {"row": 1, "kept_row": 2, "label": 3, "sid": 4, "file": 5, "held_out": 6, "score": 7, "domain": 8, "part": 9}
WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


def documents(spark, rows):
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return out.withColumns({k: F.lit(v) for k, v in CLASH.items()})


def rows_of(repeat=1):
    return [(i, t, "en", None if k % 2 else "s", 1) for k, (i, t) in enumerate(zip(IDS, TEXTS))] * repeat


LABELS = [(i, i % 2, i % 3 == 0) for i in range(30)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, q, int(t)) for i, q, t in LABELS], "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda d, labels: toxicity.score(d, labels),
    "op2": lambda d, labels: packing.pack_documents(d, WORD).where("piece = 0"),
    "op4": lambda d, labels: ordinal.score(d, labels),
    "op5": lambda d, labels: hostrules.judge(d),
    "op8": lambda d, labels: jaccard.join(d),
    "op9": lambda d, labels: wavelet.token_shards(d, BYTE),
    "op10": lambda d, labels: automaton.digest_documents(d, BYTE),
    "op10 whole": lambda d, labels: automaton.encode_documents(d, BYTE),
}
STAGES = {
    "toxicity": lambda d, labels: toxicity.keep_clean(d, labels),
    "quality": lambda d, labels: ordinal.keep_good(d, labels),
    "near_duplicates": lambda d, labels: jaccard.keep_one(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_stay_exact_and_rows_are_kept(spark, labels, name):
    key = lambda i: (i is not None, i)
    for repeat in (1, 2):
        got = [r.doc_id for r in OPERATORS[name](documents(spark, rows_of(repeat)), labels).collect()]
        assert sorted(got, key=key) == sorted(IDS * repeat, key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, labels, name):
    docs = documents(spark, rows_of())
    empty = [docs.where("false"), documents(spark, []), docs.where("doc_id < 0")]
    schema = OPERATORS[name](docs, labels).schema
    for d in empty:
        out = OPERATORS[name](d, labels)
        assert out.schema == schema and out.collect() == []


@pytest.mark.parametrize("name", STAGES)
def test_stages_return_their_rows_whole(spark, labels, name):
    docs = documents(spark, rows_of())
    assert STAGES[name](docs.where("false"), labels).collect() == []
    out = STAGES[name](docs, labels)
    assert out.columns == docs.columns
    whole = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in out.collect()} <= whole


def test_stages_without_labels_keep_all(spark, labels):
    docs = documents(spark, rows_of())
    assert toxicity.keep_clean(docs, labels.where("false")).count() == len(IDS)
    assert ordinal.keep_good(docs.where("text <> ''"), labels.where("false")).count() == 4


def test_near_duplicates_lose_no_unlike_text(spark):
    texts = [f"{w} " * 3 + f"text number {i} has words of its own like {w}{i} and {w}x{i}" for i, w in enumerate("abcd")]
    docs = documents(spark, [(1, texts[0], "", "", 0), (1, texts[1], "", "", 0), (None, texts[2], "", "", 0), (None, texts[3], "", "", 0)] * 2)
    assert sorted(r.text for r in jaccard.keep_one(docs).collect()) == sorted(texts)


def test_pages(spark):
    rows = [(None, "http://a.com/x", "<p>One, two."), (BIG, None, None), (BIG, "no host", ""), (5, "HTTP://" + "a." * 5000 + "net/es/", "<p <b>Broken &amp; open</p")]
    pages = spark.createDataFrame(rows * 2, "page_id long, url string, html string").withColumns({"text": F.lit(1), "rule": F.lit(2), "action": F.lit(3)})
    texts = htmlmain.extract(pages)
    assert sorted((str(r.page_id), r.text) for r in texts.collect())[:2] == [("1152921504606846977", "")] * 2 and texts.count() == 8
    verdicts = urlcascade.judge(pages, URL_RULES)
    assert sorted((str(r.page_id), str(r.rule), r.verdict) for r in verdicts.distinct().collect()) == [("1152921504606846977", "None", "allow"), ("5", "net/es/", "block"), ("None", "com/", "allow")]
    for f in (lambda p: htmlmain.extract(p), lambda p: urlcascade.judge(p, URL_RULES)):
        assert f(pages.where("false")).collect() == [] and f(pages.where("page_id < 0")).collect() == []


def test_neighbours_of_repeated_ids_and_in_double_precision(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0 + 1e-12, 0.0]), (BIG, [1e200, 1.0]), (6, [0.0, 2.0]), (6, [1.0, 0.0]), (None, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "class": F.lit(2), "key": F.lit(3)})
    got = sorted(tuple(r) for r in ann.search(vectors, F.col("id") % 100 == 0).collect())
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 6), (0, 2, 1), (0, 3, BIG)]
    assert got[0][3] == 0.0 and 0 < got[1][3] < 2e-12 and got[2][3] > 1e199


def test_pipeline_on_empty_documents(spark, labels, tmp_path):
    for name, df in (("documents", documents(spark, rows_of()).where("false")), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_packing_stage_takes_odd_rows(spark, tmp_path):
    name, pack = corpus_pipeline.STAGES[-1]
    docs = documents(spark, rows_of(2))
    rows = pack(spark, docs, str(tmp_path)).collect()
    assert name == "packing" and len({(r.doc_id, r.ids_crc32) for r in rows if r.piece == 0}) == len(IDS) and sum(r.piece == 0 for r in rows) == 2 * len(IDS)
    assert all(0 < r.length <= 4096 and 0 <= r.offset and r.offset + r.length <= 4096 for r in rows)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert pack(spark, docs.where("false"), str(tmp_path)).collect() == []
