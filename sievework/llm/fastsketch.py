"""Near-duplicates by fast similarity sketches: documents that share most of their word shingles, joined into components.

Words are split at ASCII white space, A-Z lower-cased. A document's set is its distinct shingles of WORDS words (all its words as one, if
they are fewer). A sketch has BINS places: in round i, every element falls into a place by its hash of the round, and the least value
there stands, a value of an earlier round before any of a later; from round BINS on, round BINS + i throws all elements into place i, so
that after 2 * BINS rounds each place is filled. Two sets agree in a place with chance their Jaccard similarity, with the concentration
of independent samples. Bands of ROWS places propose pairs, the rest of the sketch drops most of those that are unlike (both lose a linked
pair with chance under 1e-5), and links are confirmed on the full sets in whole numbers.

Documents of equal sets form one class. Large buckets are cut into tiles; a pair is compared in one tile, and tiles give links to a root,
never pairs. A document without words links with nothing and is its own component. Ids may be null or repeated: a component is named by its
smallest id, null only if it has no other; kept is false for a null id unless it names its component. Very long texts are read whole;
columns but doc_id and text are not read; an empty table gives no rows. Sets are named by 128 bits.
"""

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches, settled
from .jaccard import CACHED, TILE, classes_of, components, links, row_key, set_ids

WORDS, BINS, ROWS, SEED = 3, 100, 5, 29
PERCENT = 85
#: Places in which two sets must agree to be compared in full: seven standard deviations under what is expected of a pair just similar enough.
LEAST = 60


def miss_chance(similarity: float) -> float:
    """The chance that a pair just this similar shares no band or agrees in fewer than LEAST places."""
    bands = (1 - similarity**ROWS) ** (BINS // ROWS)
    return bands + sum(math.comb(BINS, m) * similarity**m * (1 - similarity) ** (BINS - m) for m in range(LEAST))


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Sketcher:
    """Sets of shingle hashes, their sketches and band keys."""

    def __init__(self):
        import numpy as np

        rng = np.random.default_rng(SEED)
        self.known: dict[bytes, int] = {}
        self.powers = rng.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.rounds = rng.integers(0, 1 << 63, 2 * BINS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.bands = rng.integers(0, 1 << 63, (BINS // ROWS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)

    def shingles(self, text: str | None):
        """Sorted distinct hashes."""
        import numpy as np
        import xxhash

        words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - WORDS + 1)
        out = np.full(n, min(len(h), WORDS), np.uint64)
        for k in range(min(WORDS, len(h))):
            out = _mix(out + h[k : k + n] * self.powers[k])
        return np.unique(out)

    def sketch(self, elements):
        """A value for each place: the round, and 32 bits of the hash, as one number; cut to 32 bits by a last hash."""
        import numpy as np

        none = np.uint64(0xFFFFFFFFFFFFFFFF)
        out, at = np.full(BINS, none), 0
        # as many rounds at once as fill the places by expectation
        step = max(1, math.ceil(1.2 * BINS * math.log(BINS) / max(1, len(elements))))
        while at < 2 * BINS and len(elements):
            upto = min(at + step, BINS) if at < BINS else min(at + step, 2 * BINS)
            for lo in range(0, len(elements), 1 << 14):
                h = _mix(elements[None, lo : lo + (1 << 14)] * self.rounds[at:upto, None])
                value = (np.arange(at, upto, dtype=np.uint64)[:, None] << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
                if at < BINS:
                    np.minimum.at(out, (((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).ravel().astype(np.int64), value.ravel())
                else:
                    out[at - BINS : upto - BINS] = np.minimum(out[at - BINS : upto - BINS], value.min(1))
            at = upto
            if (out != none).all():
                break
        return (_mix(out) >> np.uint64(32)).astype(np.uint32)

    def keys(self, sketch):
        """A key for each band."""
        import numpy as np

        return _mix((sketch.reshape(-1, ROWS).astype(np.uint64) * self.bands).sum(1, dtype=np.uint64)).view(np.int64)


_own: list[Sketcher] = []


def sketcher() -> Sketcher:
    if not _own:
        _own.append(Sketcher())
    return _own[0]


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, row, sid and check (the set's name), n (shingles) and sketch of every document."""
    schema = "doc_id long, row long, sid long, check long, n long, sketch binary"

    def rows(batches: Iterator) -> Iterator:
        s = sketcher()
        for batch in batches:
            sets = map(s.shingles, batch.column("text").to_pylist())
            yield arrow_rows([(*set_ids(x), len(x), s.sketch(x).tobytes()) for x in sets], schema, doc_id=batch.column("doc_id"), row=batch.column("row"))

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text"), rows, schema)


def banded(classes: DataFrame) -> DataFrame:
    """sid, key and count of the bands that two classes or more of classes(sid, sketch) share."""

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                keys = [sketcher().keys(np.frombuffer(x, np.uint32)) for x in batch.column("sketch").to_pylist()]
                yield pa.RecordBatch.from_pydict({"sid": np.repeat(batch.column("sid").to_numpy(), BINS // ROWS), "key": np.concatenate(keys)})

    bands = settled(classes.select("sid", "sketch").mapInArrow(rows, "sid long, key long"), "bands")
    return settled(bands.join(bands.groupBy("key").count().where("count > 1"), "key").select("sid", "key", "count"), "leaves")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs(doc_id, text)."""
    rows = settled(sketched(docs), "sets")
    classes = classes_of(rows.where("n > 0"))
    linked = lambda both, sizes: 100 * both >= percent * (sizes - both)
    found = links(docs, classes, banded(classes), LEAST, linked, lambda text: sketcher().shingles(text), BINS, tile)
    named = classes.select("set_a", "set_b", "sid", "doc_id").join(components(found), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = settled(named.select("set_a", "set_b", "label").join(least, "label").select(F.col("set_a").alias("sid"), F.col("set_b").alias("check"), "component_id"), "names")
    out = rows.where("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "sid", "check").join(names, ["sid", "check"]).drop("sid", "check")
    every = out.union(rows.where("n = 0").select("doc_id", "n", "doc_id"))
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
