import os
import zlib

import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def test_toxicity_learns_without_held_out_rows(spark):
    rows = entry.queries()["op1_toxicity"](spark, "/root/testdata/sf0.01").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    told = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in told) >= 0.85 * len(told)


def test_url_verdicts_equal_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{DIR}/pages.parquet'")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({entry.oracle_sql()['op6_url_filters']})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in entry.queries()["op6_url_filters"](spark, DIR).collect())


def test_base_counts(spark):
    from sievework.llm.hostrules import measure

    assert measure(None) == measure("") == (0, 0, 0, 0, 0)
    assert measure("a b c d e f\n#x\n#x\n a b c d e") == (13, 15, 2, 1, 10)
    assert measure("a a a a a a") == (6, 6, 0, 0, 6)
    rows = entry.queries()["op5_quality_rules"](spark, DIR)
    assert rows.count() == spark.read.parquet(f"{DIR}/documents.parquet").count()


def test_duplicate_lines_are_a_share_of_the_lines(spark):
    from sievework.llm.hostrules import judge, measured

    lined = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(6)] + ["one line", "one line", "one line", "one line"]
    docs = [(i, "\n".join(lined), "bad") for i in range(6)] + [(i, "\n".join(lined[:7]), "good") for i in range(6, 12)] + [(12, None, "good")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert {r.doc_id: r.lines_failed for r in measured(docs).collect()} == {i: False for i in range(13)}  # 3 of 10
    docs = docs.selectExpr("doc_id", "CASE WHEN source = 'bad' THEN concat(text, '\n', 'one line') ELSE text END AS text", "source")
    assert {r.doc_id: r.lines_failed for r in measured(docs).collect()} == {i: i < 6 for i in range(13)}
    kept = {r.doc_id: (r.base_failed, r.host_kept) for r in judge(docs).collect()}
    assert all(kept[i] == (False, i >= 6) for i in range(12))


def test_html():
    from sievework.llm.htmlmain import main_text

    page = "<html><head><title>t</title></head><body><nav><a>m, m.</a></nav><article><h1>A &amp; B</h1><p>One\n two.<p><b>Three</b><script>x='</p>'</script></article><div class='comments'><p>No, no.</p></div><footer>f</footer></body></html>"
    assert main_text(page) == "A & B One two. Three" and main_text(None) == main_text("") == ""


def test_html_paths_decide_under_article():
    from sievework.llm.htmlmain import main_text

    body = "".join(f"<p>Sentence {i}, of some length, with commas; it goes on and on, as body text does.</p>" for i in range(4))
    menu = "<ul class='x1'>" + "".join(f"<li>Item {i}</li>" for i in range(12)) + "</ul>"
    text = main_text(f"<body><article><h1>Title</h1>{body}{menu}</article></body>")
    assert text.startswith("Title Sentence 0") and "Sentence 3" in text and "Item" not in text
    text = main_text(f"<body><article><p>Teaser</p></article><div id='b'>{body}</div></body>")
    assert all(f"Sentence {i}" in text for i in range(4))


def test_ordinal():
    from sievework.llm.ordinal import fit

    m = fit(["good word here"] * 9 + ["fair wort hier"] * 9 + ["bad!! BAD!!"] * 9, [2] * 9 + [1] * 9 + [0] * 9, {0: 1 / 3, 1: 1 / 3, 2: 1 / 3})
    good, fair, bad = (m.tails(t) for t in ("good word here", "fair wort hier", "bad!! BAD!!"))
    assert m.thresholds[0] < m.thresholds[1] and good[1] > fair[1] > bad[1] and fair[0] > 0.5 > bad[0]
    assert m.tails("") == m.tails(None) == [0.0, 0.0]


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, DIR).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
