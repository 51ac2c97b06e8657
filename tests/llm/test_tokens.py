import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from sievework.llm.automaton import Automaton, digest_documents  # noqa: E402
from sievework.llm.packing import BestFit, pack_documents  # noqa: E402
from sievework.llm.tokens import CachedTokenizer  # noqa: E402
from sievework.llm.wavelet import Shard, build, token_shards  # noqa: E402

TEXTS = ["", "Hello  world\n\n it's  THE end.", "\x1cé\x85ü　 ΑΣ İ", "a<|endoftext|>b <|startoftext|>", "x" * 5000, "日本語 mixed 😀 text\t\tend  ", "aaaa aaa bbbbab abababab"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return TEXTS + ["".join(rng.choice("abcdeTHing .,'\n 0é&") for _ in range(rng.randrange(200))) for _ in range(300)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_equal_the_library(name, texts):
    lib = Tokenizer.from_file(P.path(name))
    got = CachedTokenizer(P.path(name)).ids([*texts, None])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts] + [[]]


def test_automaton_equals_the_library(texts):
    lib, auto = Tokenizer.from_file(P.path("byte_bpe_50k.json")), Automaton(P.path("byte_bpe_50k.json"))
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert auto.encode(t) == ids
        assert auto.decode(ids).decode() == lib.decode(ids, skip_special_tokens=False)


def test_wavelet_access_count_select():
    rng = random.Random(1)
    ids = [rng.randrange(40) for _ in range(3000)]
    s = Shard(build(np.array(ids, np.uint32), [7, None], [1000, 3000]))
    assert s.ids().tolist() == ids and s.doc_ids == [7, None]
    assert [s.access(i) for i in range(0, 3000, 37)] == ids[::37]
    for t in (0, 5, 39, 63, 900):
        where = [i for i, x in enumerate(ids) if x == t]
        assert s.count(t) == len(where) and s.count(t, 100, 2000) == sum(100 <= i < 2000 for i in where)
        assert [s.select(t, k) for k in range(0, len(where), 9)] == where[::9]
    assert Shard(build(np.array([], np.uint32), [], [])).ids().tolist() == []


def test_best_fit_is_bounded_and_prefers_the_fullest():
    fit = BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 3, 4, 9, 8)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    assert fit.place(5) == (4, 0) and fit.n_open == 2


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate([None, *texts])], "doc_id long, text string, piece string").repartition(3)


def test_packing_is_gapless_and_whole(spark, texts):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = pack_documents(docs(spark, texts), P.path("word_bpe_49k.json"), capacity=64).collect()
    bins, by_doc = {}, {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
    for i, t in enumerate([None, *texts]):
        ids, at = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r.piece):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert pack_documents(docs(spark, []).where("false"), P.path("word_bpe_49k.json")).count() == 0


def test_shards_round_trip(spark, texts):
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = sorted(token_shards(docs(spark, texts), P.path("byte_bpe_50k.json")).collect())
    at = 0
    for r, t in zip(rows, [None, *texts], strict=True):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_shards(docs(spark, []).where("false"), P.path("byte_bpe_50k.json")).count() == 0


def test_digests(spark, texts):
    assert digest_documents(docs(spark, texts), P.path("byte_bpe_50k.json")).count() == len(texts) + 1
