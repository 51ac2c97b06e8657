import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import classifiers, languages, segmentation
from sievework.operators.extraction import routed

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_languages(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "lang", "text").withColumn("first", F.substring("text", 1, 60))  # short texts are the hard ones
    held = docs.where("doc_id % 4 = 2")
    model = languages.learned(docs.where("doc_id % 4 <> 2"))
    share = {}
    for text in ("text", "first"):
        told = languages.with_language(held, model, text)
        assert told.columns == [*held.columns, "language"]
        r = languages.accuracy(told).agg(F.sum("n_right"), F.sum("n")).first()
        plain = held.select("lang", segmentation.language(text).alias("language"))
        s = languages.accuracy(plain).agg(F.sum("n_right"), F.sum("n")).first()
        share[text] = r[0] / r[1], s[0] / s[1]
    print("held out: trigrams, stop words", share)
    assert share["text"][0] >= 0.99 and share["text"][0] >= share["text"][1] and share["first"][0] > share["first"][1] and share["first"][0] >= 0.9


def test_language_model_equals_brute_force(spark):
    rows = [(1, "aa", "Ab ab, abc"), (2, "bb", "xyz xy9z xyz"), (3, None, "zzz"), (4, "bb", None), (5, "bb", " 12 ")]
    docs = spark.createDataFrame(rows, "id long, lang string, text string")
    model = languages.learned(docs)
    grams = {"aa": [g for w in [" ab ab abc "] for g in (w[i : i + 3] for i in range(len(w) - 2))], "bb": [g for w in [" xyz xy z xyz "] for g in (w[i : i + 3] for i in range(len(w) - 2))]}
    known = sorted({g for gs in grams.values() for g in gs})
    assert sorted(model.scores) == known and model.languages == ["aa", "bb"]
    for g in known:
        assert model.scores[g] == pytest.approx([np.log((gs.count(g) + 1) / (len(gs) + len(known))) for gs in grams.values()])
    told = {r.id: r.language for r in languages.with_language(docs, model).collect()}
    assert told == {1: "aa", 2: "bb", 3: None, 4: None, 5: None}
    none = languages.learned(docs.where("false"))
    assert none.languages == [] and languages.with_language(docs, none).where("language IS NOT NULL").count() == 0
    assert len(languages.learned(docs, kept=2).scores) == 4


def reviewed(rng, n):
    words = {"round": ["rounded", "round", "circular"], "oval": ["oval", "elliptic"], "acute": ["acute", "pointed"]}
    noise = ["the", "snout", "is", "in", "dorsal", "view", "of", "larva", "and", "body"]
    rows = []
    for _ in range(n):
        label = rng.choice(list(words))
        said = [rng.choice(noise) for _ in range(rng.randrange(6, 30))]
        said.insert(rng.randrange(len(said)), rng.choice(words[label]))
        rows.append((" ".join(said) + ".", "snout", label))
    return rows


def test_classifiers(spark, tmp_path):
    rng = random.Random(1)
    schema = "text string, attribute_id string, label string"
    rows = reviewed(rng, 400) + [(f"left {i}" if i % 2 else f"right {i}", "side/eye", "l" if i % 2 else "r") for i in range(60)] + [("only", "single", "x"), (None, "snout", "oval"), ("no label", "snout", None)]
    folder = f"{tmp_path}/models"
    made = classifiers.train(spark.createDataFrame(rows, schema), folder).collect()
    assert len(made) == 2 and all(r.size > 0 for r in made)
    test = spark.createDataFrame([(*r, i) for i, r in enumerate(reviewed(rng, 300))], schema + ", id int")
    told = classifiers.predict(test, folder).collect()
    right = sum(r["class"] == r.label for r in told)
    print("held out", right, "of", len(told))
    assert right >= 0.95 * len(told) and all(1 / 3 <= r.prob <= 1 for r in told) and told[0].asDict().keys() == {"text", "attribute_id", "label", "id", "class", "prob"}
    odd = spark.createDataFrame([("left 3", "side/eye"), ("x", "single"), ("x", "unknown"), ("x", None), (None, "snout"), ("", "snout")], "text string, attribute_id string")
    got = [(r["class"], r.prob) for r in classifiers.predict(odd, folder).collect()]
    assert got[0][0] == "l" and got[1:4] == [(None, 0.0)] * 3 and got[4] == got[5] and got[4][0] in ("round", "oval", "acute")
    again = {r.name: r.size for r in classifiers.train(spark.createDataFrame(rows, schema).repartition(5), f"{tmp_path}/again").collect()}
    assert again == {r.name: r.size for r in made}  # the same rows give the same models
    route = routed(classifiers.predict(test.where("id < 50"), folder).withColumn("kind", F.lit("categorical")))
    assert route.where("route = 'local' AND evidence IS NOT NULL").count() > 0
    assert classifiers.train(spark.createDataFrame([], schema), f"{tmp_path}/none").collect() == []


def test_gradient_is_the_softmax_one():
    """One step from nothing moves weights against the gradient that differences give."""
    texts, labels = ["red red sky", "blue sea", "green leaf sky"], ["a", "b", "a"]
    bags = [classifiers.places(t) for t in texts]
    share = {"a": 3 / 4, "b": 3 / 2}

    def loss(w, b):
        total = 0.0
        for (at, x), y in zip(bags, labels):
            z = x @ w[at] + b
            total -= share[y] * (z["ab".index(y)] - np.log(np.exp(z).sum())) / 3
        return total

    m = classifiers.Softmax.fitted(texts, labels, epochs=1)
    zero, b0 = np.zeros((classifiers.WIDTH, 2)), np.zeros(2)
    for at in bags[0][0].tolist():
        for k in (0, 1):
            up = zero.copy()
            up[at, k] = 1e-6
            slope = (loss(up, b0) - loss(zero, b0)) / 1e-6
            assert np.sign(m.weights[at, k]) == -np.sign(slope) or abs(slope) < 1e-9
    more = classifiers.Softmax.fitted(texts, labels, epochs=40)
    assert loss(more.weights.astype(float), more.bias) < loss(zero, b0)


def test_models_held_are_bounded(tmp_path):
    for i in range(classifiers.MODELS_HELD + 5):
        assert classifiers.model_of(str(tmp_path), f"a{i}") is None
    assert len(classifiers._held) == classifiers.MODELS_HELD


def test_local_predictions_equal_a_plain_form(spark):
    import pyarrow.parquet as pq

    from sievework.plans.catalogue import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    labels = [r for r in pq.read_table(f"{folder}/labels.parquet").to_pylist() if r["doc_id"] % 4 != 2 and r["doc_id"] in docs]
    want = {}
    for attribute in ("quality", "toxic"):
        rows = sorted((docs[r["doc_id"]] or "", str(r[attribute])) for r in labels if r[attribute] is not None)
        model = classifiers.Softmax.fitted([t for t, _ in rows], [y for _, y in rows])
        want |= {(i, attribute): model.predicted(t) for i, t in docs.items()}
    got = {(r.doc_id, r.attribute_id): (r["class"], r.prob) for r in QUERIES["local_predictions"](spark, folder).collect()}
    assert {k: v for k, v in got.items() if k[1] == "unknown"} == {(i, "unknown"): (None, 0.0) for i in docs}
    assert all(got[k][0] == v[0] and abs(got[k][1] - v[1]) < 1e-4 for k, v in want.items()) and len(got) == 3 * len(docs)
