"""Results of the operators against brute force, the library or planted cases."""

import hashlib
import itertools
import os
import random
import zlib
from collections import Counter

import pytest

P = pytest.importorskip("public_tokenizers")

from sievework.llm import automaton, hostrules, htmlmain, ordinal, packing, toxicity, urlcascade, wavelet  # noqa: E402
from sievework.llm.common import table  # noqa: E402

SMALL, DIR = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
CLEAN, ABUSE = "the rain fell on the quiet town and people went home early that day".split(), "idiotic moronic scummy trashy".split()


def planted(spark, n=600):
    """Documents and labels: a third toxic (two abusive words among fifty), a third poor (a word repeated), the rest good."""
    rng, docs, labels = random.Random(3), [], []
    for i in range(n):
        words = [f"{rng.choice(CLEAN)}{rng.choice(['', 'a', 'o', 'er'])}" for _ in range(rng.randrange(30, 70))]
        toxic, poor = i % 3 == 0, i % 3 == 1
        if toxic:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(ABUSE)
        if poor:
            words = [w for w in words[:5] for _ in range(12)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not poor), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_finds_planted_words_and_their_misspellings(spark):
    docs, labels = planted(spark)
    more = spark.createDataFrame([(5000, " ".join(CLEAN * 3) + " idiotiic"), (5001, " ".join(CLEAN * 300) + " moronical idiotically"), (5002, " ".join(CLEAN * 300))], docs.schema)
    got = {r.doc_id: r for r in toxicity.score(docs.union(more), labels).collect()}
    told = [i for i in range(600) if held(i)]
    assert sum(got[i].predicted for i in told if i % 3 == 0) >= 0.95 * sum(i % 3 == 0 for i in told)
    assert not any(got[i].predicted for i in told if i % 3)
    assert got[5000].predicted and got[5001].predicted and not got[5002].predicted
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 for i, r in got.items())


def test_quality_grades_one_by_one(spark):
    docs, labels = planted(spark)
    got = {r.doc_id: r for r in ordinal.score(docs, labels).collect()}
    told = [i for i in range(600) if held(i)]
    right = Counter((i % 3, round(got[i].expected_grade) == (1, 0, 2)[i % 3]) for i in told)
    assert all(right[k, True] >= 0.9 * (right[k, True] + right[k, False]) for k in range(3))
    assert all(got[i].held_out for i in told) and all(got[i].kept == (i % 3 != 1) for i in told)


@needs_tables
def test_toxicity_recall_on_the_table(spark):
    rows = toxicity.score(table(spark, DIR, "documents"), table(spark, DIR, "labels")).collect()
    toxic = {r.doc_id for r in table(spark, DIR, "labels").where("toxic = 1").collect()}
    told = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted for r in told) >= 0.5 * len(told)


def brute_counts(text):
    """The base counts of a text, by the definitions."""
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated)


@needs_tables
def test_base_counts_equal_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    rows = hostrules.judge(table(spark, SMALL, "documents")).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, lines, repeated = brute_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)


def hosts(spark):
    """Forty good hosts, a large bad one, a small one whose two documents fail, a host of one failed document and a null host."""
    rng = random.Random(1)
    good = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))
    rows = [(f"h{k}", good() if rng.random() > 0.03 else "short") for k in range(40) for _ in range(50)]
    rows += [("bad", "short" if i < 150 else good()) for i in range(200)] + [("tiny", "short")] * 2 + [("one", "short")] + [(None, good())] * 5
    return spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")


@pytest.mark.parametrize("most", [50_000, 3])
def test_hosts_are_rejected_by_evidence_and_small_ones_spared(spark, monkeypatch, most):
    monkeypatch.setattr(hostrules, "BROADCAST_HOSTS", most)
    docs = hosts(spark)
    rows = hostrules.judge(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert {r.source for r in rows if not r.host_kept} == {"bad"}
    assert all(r.kept == (r.host_kept and not r.base_failed) for r in rows)


def test_host_prior_by_hand(spark):
    rows = spark.createDataFrame([(h, i < bad, False, False) for h, n, bad in (("a", 100, 10), ("b", 100, 20), ("c", 200, 90)) for i in range(n)], "domain string, base_failed boolean, symbols_failed boolean, lines_failed boolean")
    mean, n, n2 = 120 / 400, 400, 100**2 + 100**2 + 200**2
    spread = 100 * 0.2**2 + 100 * 0.1**2 + 200 * 0.15**2
    w = (n - n2 / n - 2) / (spread / (mean * (1 - mean)) - 2) - 1
    assert hostrules.prior_strength(mean, spread, n, 3, n2) == pytest.approx(w)
    got = {r.domain: r.base_rate for r in hostrules.host_verdicts(rows).collect()}
    assert got == pytest.approx({h: (bad + mean * w) / (n + w) for h, n, bad in (("a", 100, 10), ("b", 100, 20), ("c", 200, 90))})


BODY = [f"Sentence {i}, of some length, with commas; it goes on and on, as the text of a page does." for i in range(5)]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id='c4'>{}</div>", "<div>{}</div>", "<table><tr><td>{}</td></tr></table>"])
@pytest.mark.parametrize("ad", ["<div class='ad'>Buy now, please.</div>", "<div class='x1'>Buy now.</div>", "<ul class='k'><li>Home</li><li>News</li><li>Shop</li></ul>"])
def test_ratios_choose_the_content(wrap, ad):
    page = f"<html><head><title>T</title></head><body><nav><a>m</a></nav>{ad}" + wrap.format("<h1>Title &amp; more</h1>" + "".join(f"<p>{b}</p>" for b in BODY)) + f"{ad}<footer>(c) x</footer></body></html>"
    text = "Title & more " + " ".join(BODY)
    assert htmlmain.main_text(page) == text
    assert htmlmain.main_text(page, share=0.0) != text and htmlmain.main_text(page, share=1e9) == ""


@needs_tables
def test_pages_give_their_articles(spark):
    import html
    import re

    pages = {r.page_id: r for r in table(spark, SMALL, "pages").collect()}
    for r in htmlmain.extract(table(spark, SMALL, "pages")).collect():
        article = re.search(r"(?s)<article>(.*)</article>", pages[r.page_id].html)[1]
        blocks = re.split(r"</?(?:h1|p|br)\s*/?>", article)
        want = " ".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if x)
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url


def test_cascade_is_exact_over_many_levels():
    listed = {f"a{i}/" for i in range(300)}
    universe = listed | {f"b{i}/" for i in range(20_000)}
    first = urlcascade.Bloom(listed, 0.3, 0)
    cascade = urlcascade.Cascade(listed, first, {k for k in universe if k in first})
    assert len(cascade.levels) > 2 and {k for k in universe if k in cascade} == listed


@needs_tables
def test_packing_is_gapless_whole_and_tight(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = {r.doc_id: lib.encode(r.text or "", add_special_tokens=False).ids + [1] for r in table(spark, SMALL, "documents").collect()}
    rows = packing.pack_documents(table(spark, SMALL, "documents"), P.path("word_bpe_49k.json")).collect()
    used = {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == 4096 * r.piece and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
        assert r.length == 4096 or r.start + r.length == len(ids[r.doc_id])
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert Counter(r.doc_id for r in rows) == {i: -(-len(x) // 4096) for i, x in ids.items()}
    for places in used.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(places))]
        assert [at for at, _ in sorted(places)] == ends[:-1] and ends[-1] <= 4096
    parts = table(spark, SMALL, "documents").rdd.getNumPartitions()
    assert len(used) <= sum(map(len, ids.values())) / 4096 * 1.1 + 2 * parts


@needs_tables
def test_digests_equal_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in table(spark, SMALL, "documents").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in automaton.digest_documents(table(spark, SMALL, "documents"), P.path("byte_bpe_50k.json")).collect():
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        want = len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(lib.decode(ids, skip_special_tokens=False).encode())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want


def test_shards_are_smaller_than_the_ids_and_ordered(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.3, 200_000), 40_000).astype(np.uint32)
    blob = wavelet.build(ids, [1], [len(ids)])
    assert wavelet.Shard(blob).ids().tolist() == ids.tolist() and len(blob) < 0.8 * 2 * len(ids)
    docs = spark.createDataFrame([(k % 7 if k % 5 else None, f"text {k} " * (k % 4)) for k in range(60)] + [((1 << 60) + 1, None)], "doc_id long, text string").repartition(4)
    got = wavelet.token_shards(docs, P.path("byte_bpe_50k.json")).orderBy("start").collect()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order) and [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    again = wavelet.token_shards(docs.repartition(2), P.path("byte_bpe_50k.json")).orderBy("start").collect()
    assert got == again


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    import corpus_pipeline

    docs, labels = planted(spark, 300)
    copies = docs.where("doc_id % 3 = 2").selectExpr("doc_id + 100000 AS doc_id", "concat(text, ' end') AS text")
    every = docs.union(copies).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    every.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    good = {i for i in range(300) if i % 3 == 2}
    assert len(kept & good) >= 0.97 * len(good) and not any(i % 3 != 2 for i in kept if i < 300 and held(i))
