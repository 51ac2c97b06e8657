"""The sketches, the audit of sources with its radix selection, and the interval join, against brute force."""

import random
import zlib
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sievework.llm import divergence, fastsketch, intervals
from sievework.llm.radix import first_k

BIG = (1 << 60) + 1


# near-duplicates


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((i is not None, i or 0), len(s), (c := least.get(find(k))), i == c) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def found(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in df.collect())


def near_copies(rng, word):
    texts = [None, "", " \n\t", "one two", "One TWO", "one", "one two three", "a\xa0b c d", "a b\x85c d"]
    for size in (4, 12, 40, 100, 300):
        for _ in range(20):
            base = [word() for _ in range(size)]
            texts.append(" ".join(base))
            for _ in range(rng.randrange(4)):
                near = list(base)
                for _ in range(rng.randrange(0, 2 + size // 30)):
                    near[rng.randrange(size)] = word()
                texts.append(rng.choice([" ", "\n ", "\t"]).join(near).upper())
    hot = [word() for _ in range(120)]
    for _ in range(150):
        near = list(hot)
        near[rng.randrange(120)] = word()
        texts.append(" ".join(near))
    return texts + [" ".join(hot)] * 50


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    texts = near_copies(rng, lambda: rng.choice("abcdefgh") + rng.choice("klmnop") + str(rng.randrange(60)))
    rows = [(i * 3 + (BIG if i % 50 == 0 else 0), t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, sid int, kept int, key string")
    want = components(rows)
    assert found(fastsketch.near_duplicates(docs)) == want
    assert found(fastsketch.near_duplicates(docs, tile=16)) == want  # many tiles in each bucket
    assert len({w[2] for w in want}) > 100


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = lambda i: " ".join(f"{w}{i}" for w in "abcdefghijkl")
    rows = [(None, text(1)), (5, text(1)), (4, text(1)), (None, text(2)), (7, text(3)), (7, text(3)), (7, text(4)), (9, None), (9, ""), (None, None), (3, text(4)), (8, "word " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in fastsketch.near_duplicates(docs).collect())
    want = [("None", 10, "4", False), ("5", 10, "4", False), ("4", 10, "4", True), ("None", 10, "None", True), ("7", 10, "7", True), ("7", 10, "7", True), ("7", 10, "3", False), ("9", 0, "9", True), ("9", 0, "9", True), ("None", 0, "None", True), ("3", 10, "3", True), ("8", 1, "8", True)]
    assert got == sorted(want)
    assert fastsketch.near_duplicates(docs.where("false")).collect() == []


def test_sketches_fill_and_estimate():
    import numpy as np

    s, rng = fastsketch.Sketcher(), np.random.default_rng(1)
    for n in (1, 2, 5, 30, 100, 1000, 40_000):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        assert (s.sketch(a) == s.sketch(a[::-1].copy())).all() and len(s.sketch(a)) == fastsketch.BINS
    agree = []
    for _ in range(400):  # 85 of 100 elements shared
        x = rng.integers(0, 1 << 63, 100, np.uint64)
        agree.append((s.sketch(x[:92]) == s.sketch(np.concatenate([x[:85], x[92:]]))).sum())
    assert abs(np.mean(agree) - 85) < 1 and min(agree) >= fastsketch.LEAST
    assert fastsketch.miss_chance(0.85) < 1e-5


# radix selection


def test_first_k_equals_sorting(spark):
    rng = random.Random(5)
    rows = []
    for g in range(12):
        top = rng.choice([0, 3, 5000, 1 << 40, (1 << 62) + 5])
        rows += [(None if g == 11 else f"g{g}", rng.randrange(top + 1), rng.choice([None, "", "a", "ab", "é", "\U0001f600", "z" * 9 + rng.choice("xyz"), f"w{rng.randrange(40)}"]), n) for n in range(rng.choice([1, 5, 200]))]
    rows += [("ties", 7, x, 0) for x in ["b", "a", "aa", "ü", "a", "a", "zz", "z"] * 5] + [("none", None, "x", 1)]
    df = spark.createDataFrame(rows, "g string, v long, item string, n int")
    for k in (1, 4, 10):
        want = {}
        for g, v, item, _ in rows:
            if v is not None:
                want.setdefault(g, []).append((-v, (item or "").encode()))
        want = sorted((str(g), -v, b, n) for g, vs in want.items() for n, (v, b) in enumerate(sorted(vs)[:k], 1))
        got = sorted((str(r.g), r.v, (r.item or "").encode(), r["rank"]) for r in first_k(df, ["g"], "v", "item", k).collect())
        assert got == want
    assert first_k(df.where("false"), ["g"], "v", "item", 3).collect() == []


# audit of sources


def audited(rows, least, ranks):
    from collections import Counter

    terms = lambda t: [w.decode() for w in __import__("re").findall(rb"[a-z\x80-\xff]+", (t or "").encode().lower())]
    df, n, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", terms(text)
        groups.add((lang, source))
        df.update((lang, t) for t in set(found))
        n.update((lang, source, t) for t in found)
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for (x, t), c in df.items() if x == lang and c >= least]
        sources = [s for x, s in groups if x == lang]
        share = lambda c, total: 1 + 10**9 * (c + 2) // (total + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        count = {s: {t: n[lang, s, t] for t in kept} for s in sources}
        every = {t: sum(count[s][t] for s in sources) for t in kept}
        p = {s: {t: share(c, sum(count[s].values())) for t, c in count[s].items()} for s in sources}
        q = {t: share(c, sum(every.values())) for t, c in every.items()}
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s)
            marks = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[s][t] and p[s][t] > q[t])[:ranks]
            out += [(lang, s, "pair", o, -v, k) for k, (v, o) in enumerate(pairs, 1)] + [(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(marks, 1)]
    return sorted(out)


def test_audit_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    words = ["the", "The", "THE", "straße", "É", "é", "naïve", "x1y", "a-b", "日本", "zoo", "Zoo", "q"] + [f"w{'abcdefghij'[i]}" for i in range(10)]
    rows = [(" ".join(rng.choice(words[: 4 + k % 20]) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]), f"s{k % 7}" if k % 11 else None) for k in range(150)]
    rows += [(None, "en", "empty"), ("", "xx", "a"), ("rare words only", "xx", "b"), ("123", None, "s1"), ("the " * 30_000, "de", "s2")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, term int, value string")
    want = audited(rows, 10, 10)
    got = lambda **given: sorted(tuple(r) for r in divergence.audit(docs, **given).collect())
    assert got() == want
    monkeypatch.setattr(divergence, "BLOCK", 2)  # several blocks of sources
    monkeypatch.setattr(divergence, "PAIRS", 5)
    assert got(ranks=2, least=3) == audited(rows, 3, 2)
    assert divergence.audit(docs.where("false")).collect() == []


# interval join

H = 3_600_000_000
ZERO = datetime(1970, 1, 1)


def joined(sales, lines, clicks):
    by = {}
    for client, ts, kind in clicks:
        if client is not None and ts is not None:
            by.setdefault(client, []).append((ts, kind == "purchase"))
    sessions = {}
    for client, seen in by.items():
        for ts, bought in sorted(seen):
            own = sessions.setdefault(client, [])
            if own and ts - own[-1][1] <= timedelta(minutes=10):
                own[-1] = [own[-1][0], ts, bought or (own[-1][2] and ts == own[-1][1])]
            else:
                own.append([ts, ts, bought])
    out = {}
    whole = lambda t: (t - ZERO) // timedelta(microseconds=1)
    for sale_id, client, sold in sales:
        if client is None or sold is None:
            continue
        own = [s for i, s in lines if i == sale_id and i is not None]
        a, b = whole(sold) // H, float("inf") if None in own else whole(max([sold, *own])) // H
        for first, last, is_open in sessions.get(client, []):
            c, d = whole(first) // H, float("inf") if is_open else whole(last) // H
            if a <= d and c <= b:
                side = lambda x, y: (x > y) - (x < y)
                key = sale_id, intervals.RELATIONS[3 * (side(a, c) + 1) + side(b, d) + 1]
                n, slots, crc = out.get(key, (0, None, 0))
                if min(b, d) < float("inf"):
                    slots = (slots or 0) + min(b, d) - max(a, c) + 1
                out[key] = n + 1, slots, crc + zlib.crc32(str(whole(first)).encode())
    return sorted((str(k[0]), k[1], *v) for k, v in out.items())


def shop(rng, n):
    at = lambda days: datetime(2024, 1, 1) + timedelta(microseconds=rng.randrange(days * 24 * H))
    client = lambda: rng.choice([None, 1, 1, 1, 2, 3, 4, BIG])
    clicks = []
    for _ in range(n):
        c, t = client(), at(40)
        for _ in range(rng.randrange(1, 5)):
            clicks.append((c, t, rng.choice(["view", "purchase", None])))
            t += timedelta(seconds=rng.choice([0, 30, 599, 600, 601, 4000]))
    clicks += clicks[:20] + [(2, None, "view"), (2, datetime(1969, 12, 31, 23, 59, 59, 999999), "view"), (5, at(3), "purchase"), (1, datetime(2290, 1, 1), "view")]
    sales = [(i, client(), at(40) if i % 17 else None) for i in range(n)] + [(n, 2, datetime(1969, 12, 31, 20)), (None, 1, at(5)), (None, 1, at(5)), (n + 1, 6, at(3))]
    lines = [(rng.randrange(n), rng.choice([None, *[at(60)] * 9])) for _ in range(n)] + [(None, None), (n, datetime(1970, 1, 1, 0, 30))]
    return sales, lines, clicks


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(6)
    sales, lines, clicks = shop(rng, 300)
    s = spark.createDataFrame([(*r, 1, "x") for r in sales], "sale_id long, client_id long, sold_at timestamp_ntz, side int, shard string")
    li = spark.createDataFrame(lines * 2, "sale_id long, shipped_at timestamp_ntz")
    c = spark.createDataFrame([(*r, "x") for r in clicks], "client_id long, ts timestamp_ntz, kind string, first string")
    want = joined(sales, lines, clicks)
    got = lambda df: sorted((str(r.sale_id), r.relation, r.n_pairs, r.overlap_slots, r.sessions_crc) for r in df.collect())
    assert got(intervals.join(s, li, c)) == want
    assert got(intervals.relations(intervals.sale_intervals(s, li), intervals.sessions(c), block=8)) == want  # many pairs of blocks
    assert {w[1] for w in want} >= {"overlaps", "contains", "during", "finished_by", "finishes"}
    for a, b, d in ((s.where("false"), li, c), (s, li, c.where("false"))):
        assert intervals.join(a, b, d).collect() == []
    assert got(intervals.join(s, li.where("false"), c)) == joined(sales, [], clicks)


def test_equal_starts_and_ends(spark):
    t = lambda h, m=0: datetime(2024, 1, 1, h, m)
    sales = [(i, 1, t(5)) for i in range(4)]
    lines = [(0, t(5, 30)), (1, t(7)), (2, t(9)), (3, None)]
    clicks = [(1, t(5, 10), "view"), *[(1, t(5, 10) + timedelta(minutes=9 * k), "view") for k in range(1, 14)]]
    s = spark.createDataFrame(sales, "sale_id long, client_id long, sold_at timestamp_ntz")
    li = spark.createDataFrame(lines, "sale_id long, shipped_at timestamp_ntz")
    c = spark.createDataFrame(clicks, "client_id long, ts timestamp_ntz, kind string")
    assert {r.sale_id: (r.relation, r.overlap_slots) for r in intervals.join(s, li, c).collect()} == {0: ("starts", 1), 1: ("equals", 3), 2: ("started_by", 3), 3: ("started_by", 3)}


def test_a_hot_client_in_one_hour(spark):
    rows = spark.range(20_000).select(F.col("id").alias("sale_id"), F.lit(1).cast("long").alias("client_id"), F.lit(datetime(2024, 1, 1, 5)).cast("timestamp_ntz").alias("sold_at"))
    clicks = spark.range(20_000).select(F.lit(1).cast("long").alias("client_id"), F.expr("timestamp_ntz'2024-01-01 05:00:00' + make_dt_interval(0, 0, 0, id / 10)").alias("ts"), F.lit("view").alias("kind"))
    lines = spark.createDataFrame([], "sale_id long, shipped_at timestamp_ntz")
    out = intervals.join(rows, lines, clicks)
    assert out.groupBy("relation", "n_pairs", "overlap_slots").count().collect() == [("equals", 1, 1, 20_000)]


def test_texts_split_at_spaces_have_the_library_s_ids():
    """A word that follows a space stands in the cache without it; white space that runs on is cut as the library does it."""
    import random

    import numpy as np
    from tokenizers import Tokenizer

    import public_tokenizers as P
    from sievework.llm import tokens

    draw = random.Random(11)
    bits = ["Word", "wörd.", "it's", "x1", " ", "  ", "\n", " \n", "\n ", "\t", "\x1c", "\x85", "\xa0", "\u2003", "e\u0301", "...", "日本", "a" * 70, "<|endoftext|>"]
    texts = ["", " ", "  ", " a", "a ", "a\n b", "a \n b", "a\n \nb", *("".join(draw.choice(bits[: draw.choice([6, 18, 19])]) for _ in range(draw.randrange(1, 14))) for _ in range(3000))]
    lib, tok = Tokenizer.from_file(P.path("byte_bpe_50k.json")), tokens.CachedTokenizer(P.path("byte_bpe_50k.json"))
    for _ in range(2):  # new, then from the cache
        for t, got in zip(texts, tok.ids(texts), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t
    assert {"Word", " Word"} <= tok.keys() and not any("\n" in k and k.strip() for k in tok)
    assert np.frombuffer(tok["Word"], "<u4").tolist() == lib.encode(" Word", add_special_tokens=False).ids
