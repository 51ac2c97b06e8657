"""Toxicity by subword bags: the vectors of a window's character n-grams are averaged into a linear softmax of two classes.

Vectors and softmax are trained jointly in numpy. A window is a word with the one after it (the last word of a text stands alone). A
document is toxic unless each of its windows is clean, so its score is one less the product of the windows' clean probabilities (a few
words of abuse in a long text count in full). Misspellings share n-grams. The class shares of the sample are set right to those of all
labels. Null and empty texts score 0; with one class or no labels or documents to learn from, every other score is the share of the
toxic label (0 without labels). Texts are scored whole; repeated rows score alike; an empty table gives no rows; ids may be null;
columns but doc_id and text are not read.
"""

from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches, kept_rows
from .labelled import Adam, ROWS_PER_LABEL, WordScores, fitted, held_out

BUCKETS, DIMENSIONS, SHORTEST, LONGEST = 1 << 17, 8, 3, 5
STEPS, RATE, FIRST_BIAS, DECAY = 120, 0.05, -6.0, 1e-6
THRESHOLD = 0.3
SCHEMA = "doc_id long, held_out boolean, score double"


def words(text: str | None) -> list[str]:
    return text.lower().split() if isinstance(text, str) else []


def subwords(vocabulary: list[str]):
    """(buckets, owners): of all words' character n-grams, with marks at a word's ends, and of the words; owners are word numbers."""
    import numpy as np

    marked = "".join(f"<{w}>" for w in vocabulary)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) + 2
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    place = np.arange(len(codes)) - starts[word]
    room = sizes[word] - place
    factor = np.uint64(0x9E3779B97F4A7C15)
    powers = np.cumprod(np.full(int(sizes.max()), factor))
    hashes, owners = [np.add.reduceat(codes * powers[place], starts)], [np.arange(len(sizes), dtype=np.int32)]
    gram = codes.copy()
    for n in range(2, min(LONGEST, len(codes)) + 1):
        gram[: len(codes) - n + 1] = gram[: len(codes) - n + 1] * factor + codes[n - 1 :]
        if n >= SHORTEST:
            at = np.flatnonzero(room >= n)
            hashes.append(gram[at] + np.uint64(n))
            owners.append(word[at])
    h = np.concatenate(hashes)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int32), np.concatenate(owners)


class Model:
    """value: of each bucket, its vector's part in the toxic logit less the clean one's; bias, and the odds' factor."""

    def __init__(self, value, bias: float, factor: float, constant: float | None = None):
        self.value, self.bias, self.factor, self.constant = value, bias, factor, constant
        self._scores = None

    def words(self, vocabulary: list[str]):
        """The mean over each word's subwords."""
        import numpy as np

        flat, owner = subwords(vocabulary)
        return np.bincount(owner, self.value[flat], len(vocabulary)) / np.bincount(owner, minlength=len(vocabulary))

    def score(self, text: str | None) -> float:
        import numpy as np

        tokens = words(text)
        if not tokens:
            return 0.0
        if self.constant is not None:
            return self.constant
        self._scores = self._scores or WordScores(self.words)
        s = self._scores.of(tokens)
        z = (s + np.append(s[1:], s[-1])) / 2 + self.bias
        clean = -np.logaddexp(0, z).sum()
        odds = self.factor * np.expm1(min(-clean, 500.0))
        return float(odds / (1 + odds))

    def __getstate__(self):
        return self.__dict__ | {"_scores": None}


def fit(texts: list[str], labels: list[int], shares: dict[int, float], seed: int = 7) -> Model:
    """Trains on a bounded sample; shares: of each label among all labels."""
    import numpy as np

    classes, lengths, number, tokens = array("b"), array("l"), {}, array("i")
    for text, label in zip(texts, labels):  # only numbers are kept of a text
        if ws := words(text):
            tokens.extend([number.setdefault(w, len(number)) for w in ws])
            classes.append(label)
            lengths.append(len(ws))
    y = np.array(classes, np.float64)
    if not 0 < y.sum() < len(y):
        return Model(None, 0.0, 1.0, float(shares.get(1, 0.0)))
    tokens, lengths = np.frombuffer(tokens, np.int32), np.frombuffer(lengths, np.int64)
    flat, owner = subwords(list(number))
    sizes = np.bincount(owner, minlength=len(number)).astype(np.float32)
    used, flat = np.unique(flat, return_inverse=True)
    flat = flat.astype(np.int32)
    by_bucket = np.argsort(flat, kind="stable")
    owner_by_bucket, bucket_starts = owner[by_bucket], np.searchsorted(flat[by_bucket], np.arange(len(used)))
    by_owner = np.argsort(owner, kind="stable")
    flat_by_owner, owner_starts = flat[by_owner], np.searchsorted(owner[by_owner], np.arange(len(number)))
    first = np.cumsum(lengths) - lengths
    inner = np.full(len(tokens), np.float32(0.5))  # the part of a window that its second word has
    inner[first + lengths - 1] = 0
    inner = inner[:-1]
    rng = np.random.default_rng(seed)
    vectors = Adam(rng.normal(0, 0.1, (len(used), DIMENSIONS)).astype(np.float32), RATE)
    soft = Adam(np.stack([-(r := rng.normal(0, 0.3, DIMENSIONS)), r]), RATE)
    bias = Adam(np.array([FIRST_BIAS]), RATE)
    for _ in range(STEPS):
        line = (soft.x[1] - soft.x[0]).astype(np.float32)
        value = vectors.x @ line
        by_word = np.add.reduceat(value[flat_by_owner], owner_starts) / sizes
        z = by_word[tokens]
        z[:-1] += (z[1:] - z[:-1]) * inner
        odds = np.exp(np.minimum(z + np.float32(bias.x[0]), 60))
        clean = -np.add.reduceat(np.log1p(odds), first)
        pull = np.where(y > 0, -1 / np.expm1(np.clip(-clean, 1e-9, 500.0)), 1.0) / len(y)
        dz = (odds / (1 + odds)) * np.repeat(pull.astype(np.float32), lengths)
        d_token = dz.copy()
        d_token[:-1] -= dz[:-1] * inner
        d_token[1:] += dz[:-1] * inner
        d_word = (np.bincount(tokens, d_token, len(number)) / sizes).astype(np.float32)
        d_value = np.add.reduceat(d_word[owner_by_bucket], bucket_starts) + np.float32(DECAY) * value
        d_line = vectors.x.T @ d_value
        vectors.step(np.outer(d_value, line))
        soft.step(np.stack([-d_line, d_line]))
        bias.step(np.array([dz.sum()]))
    value = np.zeros(BUCKETS, np.float32)
    value[used] = vectors.x @ (soft.x[1] - soft.x[0])
    drawn = y.mean()
    true = shares.get(1, drawn)
    return Model(value, float(bias.x[0]), float(true / (1 - true) * (1 - drawn) / drawn))


def score(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs(doc_id, text), learned from labels(doc_id, toxic)."""
    model = fitted(docs, labels, F.col("toxic"), fit, rows)

    def scored(batches: Iterator) -> Iterator:
        for batch in batches:
            yield arrow_rows([(model.score(t),) for t in batch.column("text").to_pylist()], SCHEMA, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"))

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return in_batches(read, scored, SCHEMA).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = ROWS_PER_LABEL) -> DataFrame:
    """The rows of docs whose text scores under the threshold, with their columns; each row is judged by itself."""
    model = fitted(docs, labels, F.col("toxic"), fit, rows)
    return kept_rows(docs, "text", lambda t: model.score(t) < threshold)
