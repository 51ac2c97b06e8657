import random

from pyspark.sql import functions as F

from sievework.llm.jaccard import join, keep_one


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(shingles(t)), []).append(i)
    keys = list(sets)
    root, count = {k: k for k in keys}, dict.fromkeys(keys, 0)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in range(len(keys)):
        for y in range(x):
            a, b = keys[x], keys[y]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                count[a] += 1
                count[b] += 1
                root[find(a)] = find(b)
    group = {}
    for k in keys:
        group[find(k)] = min(group.get(find(k), 1 << 60), *sets[k])
    return {i: (min(sets[k]), group[find(k)], len(sets[k]), count[k]) for k in keys for i in sets[k]}


def test_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(90))
    texts = [None, "", " \n", "one two", "one two", "one two three"]
    for size in (40, 120, 300):
        for _ in range(25):
            base = [word() for _ in range(size)]
            texts.append(" ".join(base))
            for _ in range(rng.randrange(4)):
                near = list(base)
                for _ in range(rng.randrange(0, 1 + size // 60)):
                    near[rng.randrange(size)] = word()
                texts.append(" ".join(near))
    hot = [word() for _ in range(200)]
    for _ in range(900):
        near = list(hot)
        near[rng.randrange(200)] = word()
        texts.append(" ".join(near))
    texts += [" ".join(hot)] * 300
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, sid string, key int")
    got = {r.doc_id: tuple(r)[1:] for r in join(docs).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    assert all(got[i][0] == want[i][0] and got[i][2] == want[i][2] for i in want)
    assert sum(g[3] for g in got.values()) >= 0.97 * sum(w[3] for w in want.values())
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert abs(kept.count() - len({w[1] for w in want.values()})) <= 2


def test_null_and_repeated_ids(spark):
    text = lambda i: " ".join(f"{w}{i}" for w in "abcdefghijkl")
    rows = [(None, text(i)) for i in range(20)] + [(7, text(i)) for i in range(20, 30)] + [(i, text(i)) for i in range(30, 40)]
    rows += [(None, text(3)), (99, text(4)), (7, text(25)), (7, text(38)), (None, None), (None, None)]
    kept = [tuple(r) for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(t or "" for _, t in kept) == sorted([text(i) for i in range(40)] + [""])
    ids = {t: i for i, t in kept}
    assert ids[text(3)] is None and ids[text(4)] == 99 and ids[text(25)] == ids[text(38)] == 7 and ids[text(39)] == 39


def test_runs_reach_the_target_recall():
    import numpy as np
    import pandas as pd

    from sievework.llm import jaccard as j

    runs, rng, pairs = j.runs_for(0.8), np.random.default_rng(5), 3000
    assert j.expected_recall(runs, 0.8) >= j.TARGET_RECALL > j.expected_recall(runs - 1, 0.8)
    sketches = []
    for _ in range(pairs):  # 80 of 100 elements shared
        x = rng.integers(0, 1 << 63, 100, np.uint64)
        sketches += [j.shingler().sketch(x[:90]), j.shingler().sketch(np.concatenate([x[:80], x[90:]]))]
    rows = pd.DataFrame({"sid": range(2 * pairs), "sketch": [s.tobytes() for s in sketches]})
    nodes = next(iter(j._extend([rows], j.MAX_DEPTH, runs)))
    keys = nodes.groupby("sid")["key"].agg(set)
    near = [(sketches[i] == sketches[i + 1]).sum() >= j.least_shared(0.8) for i in range(0, 2 * pairs, 2)]
    found = sum(ok and bool(keys.get(2 * i, set()) & keys.get(2 * i + 1, set())) for i, ok in enumerate(near))
    print("recall", found / pairs, "of", pairs)
    assert found >= (j.TARGET_RECALL - 0.004) * pairs


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert join(docs).count() == 0 and keep_one(docs.withColumn("x", F.lit(1))).count() == 0
