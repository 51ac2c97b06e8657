"""Quality by ordinal cumulative-link regression: P(grade > k) = logistic(z - t_k), one shared set of weights, ordered thresholds.

z is linear in two poolings of a text's hashed word features (the word, its first four and last three characters, its shape; a word
that stands right after itself counts as AGAIN): the mean of a first weight over the words, less log(1 + the sum of e^(a second weight)).
The mean tells texts that are poor throughout; the second lets a few words that mark a lower grade count in a long text as well.
Expected grade and tail probability come from the same thresholds. Grades are small integers from 0.

Null and empty texts get grade 0 and tail 0; without two grades to learn from, every tail is the share of the upper grades, and with no
labels at all every document is kept (tail 1), as nothing speaks against it. Texts are scored whole; repeated rows score alike; an empty
table gives no rows; ids may be null; columns but doc_id and text are not read.
"""

import re
import zlib
from array import array
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches, kept_rows
from .labelled import Adam, ROWS_PER_LABEL, WordScores, fitted, held_out

BUCKETS, FEATURES, STEPS, RATE, DECAY, FIRST_MARK, MOST_MARK = 1 << 18, 4, 150, 0.3, 1e-5, -7.0, 50.0
#: A document is kept if its grade reaches GRADE with at least this probability.
GRADE, TAIL = 1, 0.5
SCHEMA = "doc_id long, held_out boolean, expected_grade double, tail double"
_SHAPES = [(re.compile(r"[^\W\d_]+"), lambda m: "A" if len(m.group()) > 1 and m.group().isupper() else "a"), (re.compile(r"\d+"), "0")]


def grades() -> Column:
    """2 for good and not toxic, 1 for good but toxic, 0 for not good: the ratings at hand have two values each."""
    return F.when(F.col("quality") > 0, F.when(F.col("toxic") > 0, 1).otherwise(2)).when(F.col("quality").isNotNull(), 0)


#: Stands for a word that only repeats the one before it.
AGAIN = "<again>"


def words(text: str | None) -> list[str]:
    tokens = text.split() if isinstance(text, str) else []
    return tokens[:1] + [b if a != b else AGAIN for a, b in zip(tokens, tokens[1:])]


def features(word: str) -> list[int]:
    """Buckets of a word's features."""
    shape, low = word, word.lower()
    for pattern, to in _SHAPES:
        shape = pattern.sub(to, shape)
    return [zlib.crc32(f.encode("utf-8", "replace")) % BUCKETS for f in ("w" + low, "b" + low[:4], "e" + low[-3:], "s" + shape)]


class Model:
    def __init__(self, weights, thresholds: list[float], shares: dict[int, float]):
        self.weights, self.thresholds, self.shares, self._scores = weights, thresholds, shares, None

    def words(self, vocabulary: list[str]):
        import numpy as np

        return self.weights[np.array([features(w) for w in vocabulary])].mean(1)

    def tails(self, text: str | None) -> list[float]:
        """P(grade >= 1), P(grade >= 2) and so on."""
        import numpy as np

        tokens = words(text)
        if not tokens:
            return [0.0] * max(1, len(self.thresholds))
        if self.weights is None:
            return [float(sum(p for g, p in self.shares.items() if g > 0)) if self.shares else 1.0]
        self._scores = self._scores or WordScores(self.words)
        mean, mark = self._scores.of(tokens).T
        z = float(mean.mean() - np.log1p(np.exp(np.minimum(mark + FIRST_MARK, MOST_MARK)).sum()))
        return [float(1 / (1 + np.exp(min(t - z, 500.0)))) for t in self.thresholds]

    def tail(self, text: str | None, grade: int) -> float:
        tails = self.tails(text)
        return tails[min(grade, len(tails)) - 1]

    def __getstate__(self):
        return self.__dict__ | {"_scores": None}


def fit(texts: list[str], graded: list[int], shares: dict[int, float]) -> Model:
    """Trains on a bounded sample, each grade weighted by the root of its share among all labels, so that rare grades count too."""
    import numpy as np

    grade, lengths, number, tokens = array("b"), array("l"), {}, array("i")
    for text, g in zip(texts, graded):  # only numbers are kept of a text
        if ws := words(text):
            tokens.extend([number.setdefault(w, len(number)) for w in ws])
            grade.append(g)
            lengths.append(len(ws))
    y = np.array(grade, int)
    if len(set(grade)) < 2:
        return Model(None, [], shares)
    top = int(y.max())
    tokens, lengths = np.frombuffer(tokens, np.int32), np.frombuffer(lengths, np.int64)
    first = np.cumsum(lengths) - lengths
    hashed = array("i")
    for w in number:
        hashed.extend(features(w))
    used, flat = np.unique(np.frombuffer(hashed, np.int32), return_inverse=True)
    flat = flat.astype(np.int32)
    by_bucket = np.argsort(flat, kind="stable")
    word_by_bucket, bucket_starts = (by_bucket // FEATURES).astype(np.int32), np.searchsorted(flat[by_bucket], np.arange(len(used)))
    by_word = np.argsort(tokens, kind="stable")
    text_by_word, word_starts = np.repeat(np.arange(len(y), dtype=np.int32), lengths)[by_word], np.searchsorted(tokens[by_word], np.arange(len(number)))
    flat = flat.reshape(-1, FEATURES)
    weight = np.array([shares[int(g)] ** 0.5 / (y == g).mean() for g in y])
    weight /= weight.sum()
    weights, cuts = [Adam(np.zeros(len(used), np.float32), RATE) for _ in range(2)], Adam(np.array([-2.0] + [1.0] * (top - 1)), RATE / 10)  # first cut, log gaps
    rows = np.arange(len(y))
    for _ in range(STEPS):
        gaps = np.exp(cuts.x[1:])
        t = np.concatenate([cuts.x[:1], cuts.x[0] + np.cumsum(gaps)])
        mean, mark = (w.x[flat].mean(1) for w in weights)
        mark = np.exp(np.minimum(mark + np.float32(FIRST_MARK), MOST_MARK))
        sums = np.add.reduceat(mark[tokens], first)
        z = np.add.reduceat(mean[tokens], first) / lengths - np.log1p(sums)
        tail = 1 / (1 + np.exp(np.minimum(t[None, :] - z[:, None], 500.0)))
        edge = np.concatenate([np.ones((len(y), 1)), tail, np.zeros((len(y), 1))], 1)
        hi, lo = edge[rows, y], edge[rows, y + 1]
        p = np.maximum(hi - lo, 1e-12)
        dz = -weight * (hi * (1 - hi) - lo * (1 - lo)) / p
        slope = np.zeros((len(y), top + 2))  # of the loss by each tail
        slope[rows, y] -= weight / p
        slope[rows, y + 1] += weight / p
        dt = -(slope[:, 1:-1] * tail * (1 - tail)).sum(0)
        for w, by_text, factor in ((weights[0], dz / lengths, 1), (weights[1], -dz / (1 + sums), mark)):
            d_word = np.add.reduceat(by_text.astype(np.float32)[text_by_word], word_starts) * factor / FEATURES
            w.step(np.add.reduceat(d_word[word_by_bucket], bucket_starts) + np.float32(DECAY) * w.x)
        cuts.step(np.concatenate([[dt.sum()], [dt[k:].sum() * gaps[k - 1] for k in range(1, top)]]))
    out = np.zeros((BUCKETS, 2), np.float32)
    out[used] = np.stack([w.x for w in weights], 1)
    t = np.concatenate([cuts.x[:1], cuts.x[0] + np.cumsum(np.exp(cuts.x[1:]))])
    return Model(out, t.tolist(), shares)


def score(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_LABEL, grade: int = GRADE, least: float = TAIL) -> DataFrame:
    """doc_id, held_out, expected_grade, tail (P(grade >= `grade`)) and kept for every row of docs(doc_id, text)."""
    model = fitted(docs, labels, grades(), fit, rows)

    def scored(batches: Iterator) -> Iterator:
        for batch in batches:
            tails = [model.tails(t) for t in batch.column("text").to_pylist()]
            yield arrow_rows([(sum(t), t[min(grade, len(t)) - 1]) for t in tails], SCHEMA, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"))

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return in_batches(read, scored, SCHEMA).withColumn("kept", F.col("tail") >= least)


def keep_good(docs: DataFrame, labels: DataFrame, grade: int = GRADE, least: float = TAIL, rows: int = ROWS_PER_LABEL) -> DataFrame:
    """The rows of docs that reach the grade with at least that probability, with their columns; each row is judged by itself."""
    model = fitted(docs, labels, grades(), fit, rows)
    return kept_rows(docs, "text", lambda t: model.tail(t, grade) >= least)
