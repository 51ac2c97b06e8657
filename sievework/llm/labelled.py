"""Bounded samples of labelled texts, for the classifiers, and scoring of whole texts by sums over words."""

import pickle
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches

#: Labelled rows of each label value that a classifier is fitted on, at most.
ROWS_PER_LABEL = 2500


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 by 4; such rows are never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, label: Column, fit, rows: int = ROWS_PER_LABEL):
    """fit(texts, labels, shares) on at most `rows` texts for each label value, by a hash order; shares: of each value among all labels.

    Only the chosen ids, a bounded number, are broadcast to the scan of the texts, and one task trains on that bounded sample, of an id
    that stands in several rows one text (of the smallest hash); the driver gets the model. Null labels and held-out rows take no part; a document with several labels has the largest. With no text to
    learn from (no labels, no documents, only empty texts), fit gets empty lists.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r.y: r["count"] for r in ids.groupBy("y").count().collect()}  # one row for each grade
    chosen = [r for y in sorted(counts) for r in ids.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
    total = sum(counts.values())
    shares = {y: n / total for y, n in counts.items()}
    if not chosen:
        return fit([], [], shares)
    few = docs.sparkSession.createDataFrame(chosen, "doc_id long, y int")
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id").where("text != ''")
    picked = picked.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "y")

    def train(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = {}  # of equal texts the label of the largest id
        for batch in batches:
            for doc_id, text, y in zip(*(c.to_pylist() for c in batch.columns)):
                held[text] = max(held.get(text, (doc_id, y)), (doc_id, y))
        texts = sorted(held, key=lambda t: (held[t], t))
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit(texts, [held[t][1] for t in texts], shares))]})

    got = in_batches(picked.repartition(1), train, "model binary").first()
    return pickle.loads(got.model) if got else fit([], [], shares)


class Adam:
    """Plain Adam over one array."""

    def __init__(self, x, rate: float):
        import numpy as np

        self.x, self.rate, self.m, self.v, self.t = x, rate, np.zeros_like(x), np.zeros_like(x), 0

    def step(self, g) -> None:
        import numpy as np

        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        self.x -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


class WordScores:
    """A bounded cache of a row of numbers for each word. score takes a list of words, so that new words are scored together."""

    def __init__(self, score, most_bytes: int = 64 << 20):
        self.score, self.most_bytes, self.known, self.rows, self.held = score, most_bytes, {}, None, 0

    def of(self, words: list[str]):
        import numpy as np

        if self.held > self.most_bytes:
            self.known, self.rows, self.held = {}, None, 0
        known, n = self.known, len(self.known)
        if new := list(set(words).difference(known)):
            scores = self.score(new)
            if self.rows is None or len(self.rows) < n + len(new):
                grown = np.empty((2 * (n + len(new)), *scores.shape[1:]))
                grown[:n] = 0 if self.rows is None else self.rows[:n]
                self.rows = grown
            self.rows[n : n + len(new)] = scores
            known.update(zip(new, range(n, n + len(new))))
            self.held += sum(map(len, new)) + 160 * len(new)
        return self.rows[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
