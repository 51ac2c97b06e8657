"""Cases of the findings of round 4."""

import random

import numpy as np

from sievework.operators import classifiers


def plain(rows, epochs):
    """Probabilities of classes by one dense softmax, fitted by Adam on all rows (text, label); a function of a text."""
    classes = sorted({y for _, y in rows})
    x, y = np.zeros((len(rows), classifiers.WIDTH)), np.zeros((len(rows), len(classes)))
    for i, (text, label) in enumerate(rows):
        at, v = classifiers.places(text)
        x[i, at], y[i, classes.index(label)] = v, 1
    used = np.flatnonzero(x.any(0))
    x = x[:, used]
    weight = (1 / (len(classes) * y.sum(0)))[y.argmax(1)]
    state = [[np.zeros((len(used), len(classes))), np.zeros(len(classes))] for _ in range(3)]
    (w, b), m, v = state
    for t in range(1, epochs + 1):
        p = np.exp(x @ w + b)
        error = (p / p.sum(1, keepdims=True) - y) * weight[:, None]
        for k, (of, d) in enumerate(((w, x.T @ error + classifiers.DECAY * w), (b, error.sum(0)))):
            m[k], v[k] = m[k] + 0.1 * (d - m[k]), v[k] + 0.001 * (d * d - v[k])
            of -= classifiers.RATE * m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    place = {a: i for i, a in enumerate(used.tolist())}

    def told(text):
        at, v = classifiers.places(text)
        keep = [i for i, a in enumerate(at.tolist()) if a in place]
        z = np.exp(v[keep] @ w[[place[a] for a in at[keep].tolist()]] + b)
        return dict(zip(classes, z / z.sum()))

    return told


def reviewed():
    rng = random.Random(4)
    said = lambda *more: " ".join([*(f"w{rng.randrange(60)}" for _ in range(6)), *more])
    shape = [(said("round" if i % 3 else "flat", f"n{i}"), "shape", "r" if rng.random() < (0.8 if i % 3 else 0.1) else "f") for i in range(3000)]
    side = [(t, "side", rng.choice("xyz")) for t, _, _ in shape[:300]]
    return [*shape, *side, ("", "shape", "f"), (None, "shape", "r"), (None, None, "r"), ("a", "shape", None), (None, "bare", "1"), ("", "bare", "2"), ("", "bare", "1"), ("a", "one", "1")]


def test_local_classifiers_learn_from_all_rows(spark, tmp_path, monkeypatch):
    rows, epochs, schema = reviewed(), 25, "text string, attribute_id string, label string"
    df = spark.createDataFrame(rows, schema)
    made = classifiers.train(df, f"{tmp_path}/m", epochs).collect()
    assert sorted(r.name for r in made) == sorted(map(classifiers.file_name, ("shape", "side", "bare")))
    for attribute in ("shape", "side", "bare"):
        mine = [(t, y) for t, a, y in rows if a == attribute and y is not None]
        assert attribute != "shape" or min(sum(y == c for _, y in mine) for c in "rf") > 1000
        told, model = plain(mine, epochs), classifiers.model_of(f"{tmp_path}/m", attribute)
        for text in [*[t for t, _ in mine[::50]], "round", "flat", "none such", "", None]:
            best, p = model.predicted(text)
            assert abs(told(text)[best] - p) < 1e-5 and p > max(told(text).values()) - 1e-5
    monkeypatch.setattr(classifiers, "COLUMNS", 1)  # an attribute at a time, other parts and another order: the same models
    classifiers.train(df.repartition(3, "label").orderBy("text"), f"{tmp_path}/again", epochs).collect()
    for r in made:
        assert (tmp_path / "again" / r.name).read_bytes() == (tmp_path / "m" / r.name).read_bytes()


def test_sums_over_blocks_are_exact(monkeypatch):
    rows = [r for r in reviewed() if r[1] in ("shape", "side") and r[2]]
    classes, rng = {"shape": ["f", "r"], "side": ["x", "y", "z"]}, np.random.default_rng(1)
    given = [np.array([0.5 / 1500] * 2), np.array([1 / 300] * 3)], rng.normal(size=(3, classifiers.WIDTH)), rng.normal(size=3)
    whole = classifiers.pulled(classifiers.blocks(rows, classes), *given)
    monkeypatch.setattr(classifiers, "BLOCK", 100)
    some = list(classifiers.blocks(rows[::-1], classes))
    again = classifiers.pulled(some, *given)
    assert len(some) > 100 and all(np.array_equal(a, b) and np.any(a) and np.abs(a).max() < 2**53 for a, b in zip(whole, again))
    once = list(classifiers.blocks([("a b", "shape", "f"), ("a b", "side", "x"), ("a b", "side", "y")], classes))
    assert [len(b[3]) for b in once] == [2] and once[0][5].tolist() == [[0, 0], [-1, 1]]  # one bag for two attributes
