"""Jaccard join on word shingles by chosen paths.

Texts with equal shingle sets form one class. The runs are as many as TARGET_RECALL takes, for a pair just similar enough. In each, the
classes descend a tree: a node picks one or two tokens of a set's MinHash sketch by the node's own hash, and the child's name holds the
token. Buckets over BUCKET classes are split further, to MAX_DEPTH; what is left is compared by brute force, in tiles of bounded size,
first by sketch (which may lose FILTER_SHARE of what the target allows to be lost) and then on the exact shingle sets. A pair is counted
only in the least of the buckets that both share, so no pair is ever emitted: tiles give each class its number of links and a root within
the tile, and components are found over these.

A text of fewer than SIZE words has one shingle, all its words. Null and empty texts have none: they form one class and link to none. A
null id takes part; a class's name is its smallest id, null if it has no other. Ids may be null or repeated in any number of rows, with
any texts: rows are found again by a hash of id and text, never by the id alone. Very long texts are read whole; an empty table gives no
rows; join reads no column but doc_id and text, keep_one returns all columns, whatever their names. Sets are named by 128 bits, rows by
their id and 64 bits.
"""

import itertools
import math
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches, settled

SIZE, SIMILARITY = 5, 0.8
TARGET_RECALL, FIRST_DEPTH, STEP, MAX_DEPTH, BUCKET, SKETCH, SEED = 0.995, 2, 2, 6, 64, 64, 23
#: Classes in a block (a tile compares two), and salts for the members of hot groups.
TILE, SALTS = 384, 32
#: The part of the pairs the target allows to be lost that the sketch filter may lose.
FILTER_SHARE = 0.1
CACHED = 300_000


def least_shared(similarity: float, target: float = TARGET_RECALL) -> int:
    """The most sketch positions that may be asked of a pair, so that one just similar enough is lost by it no oftener than FILTER_SHARE allows."""
    lost = 0.0
    for m in range(SKETCH + 1):
        lost += math.comb(SKETCH, m) * similarity**m * (1 - similarity) ** (SKETCH - m)
        if lost > FILTER_SHARE * (1 - target):
            return m
    return SKETCH


def expected_recall(runs: int, similarity: float, target: float = TARGET_RECALL) -> float:
    """The chance that a pair passes the sketch filter and shares a bucket of MAX_DEPTH, over the sketch positions it may share."""
    total = 0.0
    for m in range(least_shared(similarity, target), SKETCH + 1):
        p, apart = m / SKETCH, 0.0
        for _ in range(MAX_DEPTH):
            lost = 1 - p + p * apart
            apart = 0.75 * lost + 0.25 * lost * lost
        total += math.comb(SKETCH, m) * similarity**m * (1 - similarity) ** (SKETCH - m) * (1 - apart**runs)
    return total


def runs_for(similarity: float, target: float = TARGET_RECALL) -> int:
    """The fewest runs whose expected recall at the least similarity reaches the target."""
    return next(n for n in itertools.count(1) if expected_recall(n, similarity, target) >= target)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles, and MinHash sketches of them."""

    def __init__(self):
        import numpy as np

        rng = np.random.default_rng(SEED)
        self.known: dict[str, int] = {}
        self.factors = rng.integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
        self.terms = rng.integers(0, 1 << 63, SKETCH, np.uint64)
        self.powers = rng.integers(0, 1 << 63, SIZE, np.uint64) * np.uint64(2) + np.uint64(1)

    def shingles(self, text: str | None):
        import numpy as np
        import xxhash

        words = text.split() if isinstance(text, str) else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - SIZE + 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(SIZE, len(h))):
            out = out + h[k : k + n] * self.powers[k]
        out ^= out >> np.uint64(29)
        return np.unique(out * np.uint64(0x9E3779B97F4A7C15))

    def sketch(self, shingles):
        import numpy as np

        low = np.full(SKETCH, 1 << 63, np.uint64) * np.uint64(2) - np.uint64(1)
        for at in range(0, len(shingles), 4096):
            hashed = self.factors[:, None] * shingles[at : at + 4096]
            hashed += self.terms[:, None]
            low = np.minimum(low, hashed.min(1))
        return (low >> np.uint64(32)).astype(np.uint32)


_own: list[Shingler] = []


def shingler() -> Shingler:
    if not _own:
        _own.append(Shingler())
    return _own[0]


def set_ids(shingles) -> tuple[int, int]:
    """The two signed 64-bit halves of a shingle set's 128-bit name."""
    import xxhash

    high, low = divmod(xxhash.xxh3_128_intdigest(shingles.tobytes()), 1 << 64)
    return high - (1 << 63), low - (1 << 63)


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def descend(nodes, rows, sketches, steps: int):
    """Children after some steps: (nodes, rows). A node picks a sketch position by its hash, and with chance 1/4 a second one."""
    import numpy as np

    for _ in range(steps):
        h = _mix(nodes)
        second = np.flatnonzero((h >> np.uint64(40)) & np.uint64(3) == 0)
        at = np.concatenate([np.arange(len(nodes)), second])
        pick = np.concatenate([h & np.uint64(SKETCH - 1), (h[second] >> np.uint64(8)) & np.uint64(SKETCH - 1)])
        nodes, rows = nodes[at], rows[at]
        nodes = _mix(nodes * np.uint64(3) + (pick << np.uint64(32)) + sketches[rows, pick.astype(int)].astype(np.uint64) + np.uint64(1))
    return nodes, rows


def row_key():
    """A 64-bit name for a row, by doc_id (null too) and text."""
    return F.xxhash64("doc_id", "text")


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, row, sid and check (the set's name), n (shingles) and sketch of every document."""

    schema = "doc_id long, row long, sid long, check long, n long, sketch binary"

    def rows(batches: Iterator) -> Iterator:
        s = shingler()
        for batch in batches:
            sets = map(s.shingles, batch.column("text").to_pylist())
            yield arrow_rows([(*set_ids(x), len(x), s.sketch(x).tobytes()) for x in sets], schema, doc_id=batch.column("doc_id"), row=batch.column("row"))

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text"), rows, schema)


def classes_of(rows: DataFrame) -> DataFrame:
    """A row for each set of rows (as sets_of gives them): its name (set_a, set_b), sid (a number of its own, its first half but for sets
    that share that), doc_id and row (of its row with the smallest id, null last), n, sketch and n_copies."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    sets = rows.groupBy(F.col("sid").alias("set_a"), F.col("check").alias("set_b")).agg(first.alias("first"), F.max("n").alias("n"), F.any_value("sketch").alias("sketch"), F.count(F.lit(1)).alias("n_copies"))
    sets = settled(sets.select("set_a", "set_b", "first.doc_id", "first.row", "n", "sketch", "n_copies"), "classes")
    clash = settled(sets.groupBy("set_a").count().where("count > 1").select("set_a", F.lit(True).alias("shared")), "clashes")
    if not clash.take(1):
        return sets.withColumn("sid", F.col("set_a"))
    named = F.when(F.col("shared"), F.xxhash64("set_a", "set_b")).otherwise(F.col("set_a"))
    return sets.join(clash, "set_a", "left").withColumn("sid", named).drop("shared")


def buckets(classes: DataFrame, runs: int) -> DataFrame:
    """sid, key and count: the final buckets of some runs, of two classes or more (count of them), of classes(sid, sketch)."""

    def first(batches: Iterator) -> Iterator:
        yield from _extend(batches, FIRST_DEPTH, runs)

    def further(batches: Iterator) -> Iterator:
        yield from _extend(batches, STEP)

    schema, done, depth = "sid long, key long", [], FIRST_DEPTH
    rows = classes.select("sid", "sketch").mapInPandas(first, schema)
    while True:
        rows = settled(rows.distinct(), "paths")
        sizes = settled(rows.groupBy("key").count().where("count > 1"), "sizes")
        last = depth >= MAX_DEPTH
        large = sizes.where(F.col("count") > BUCKET)
        if last or not large.take(1):
            done.append(rows.join(sizes, "key"))
            break
        done.append(rows.join(sizes.where(F.col("count") <= BUCKET), "key"))
        rows = rows.join(large.select("key"), "key").join(classes.select("sid", "sketch"), "sid").select("sid", "key", "sketch").mapInPandas(further, schema)
        depth += STEP
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return settled(out.select("sid", "key", "count").distinct(), "leaves")


def _extend(batches: Iterator, steps: int, runs: int = 0) -> Iterator:
    """Children of the rows' nodes, or with runs, of their roots."""
    import numpy as np
    import pandas as pd

    for pdf in batches:
        if len(pdf):
            sketches = np.frombuffer(b"".join(pdf["sketch"]), np.uint32).reshape(len(pdf), SKETCH)
            rows = np.arange(len(pdf))
            if runs:
                nodes = np.repeat(_mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(7919)), len(pdf))
                rows = np.tile(rows, runs)
            else:
                nodes = pdf["key"].to_numpy(np.int64).view(np.uint64)
            nodes, rows = descend(nodes, rows, sketches, steps)
            yield pd.DataFrame({"sid": pdf["sid"].to_numpy()[rows], "key": nodes.view(np.int64)})


def tiles_of(batches: Iterator, least_rows: int = 4096) -> Iterator:
    """(batch, starts of its tiles) of batches sorted by their column `tile`; a batch holds whole tiles only."""
    import numpy as np
    import pyarrow as pa

    def cut(held: list):
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        tile = whole.column("tile").to_numpy()
        return whole, np.concatenate([[0], np.flatnonzero(tile[1:] != tile[:-1]) + 1])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= least_rows:
            whole, starts = cut(held)
            last = int(starts[-1])
            if last:
                yield whole.slice(0, last), starts[:-1]
            held, n = [whole.slice(last)], 0 if last == 0 else whole.num_rows - last
    if held:
        whole, starts = cut(held)
        yield whole, starts


def members_of(batch) -> tuple:
    """Arrays of a batch of tiles: key, block and whether the tile compares two blocks, and the flat keys of its rows with their ends."""
    import numpy as np

    of = {c: batch.column(c).to_numpy() for c in ("key", "block", "a", "b")}
    keys = batch.column("keys")
    ends = np.cumsum(np.append(0, keys.value_lengths().to_numpy()))
    return of["key"], of["block"], of["a"] != of["b"], keys.flatten().to_numpy(), ends


def owned(similar, lo: int, hi: int, members: tuple):
    """The pairs (upper triangle of a matrix) of a tile's rows lo to hi that are similar, of different blocks if it compares two, and
    share no key less than the tile's."""
    import numpy as np

    key, block, across, flat, ends = members
    pairs = np.triu(similar, 1)
    if across[lo]:
        pairs &= block[lo:hi, None] != block[None, lo:hi]
    if not pairs.any():
        return pairs
    keys = flat[ends[lo] : ends[hi]]
    owner = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
    less = keys < key[lo]
    if less.any():
        kinds, which, counts = np.unique(keys[less], return_inverse=True, return_counts=True)
        shared = counts > 1
        if shared.any():
            use = shared[which]
            held = np.zeros((hi - lo, int(shared.sum())), np.float32)
            held[owner[less][use], (np.cumsum(shared) - 1)[which[use]]] = 1
            pairs &= held @ held.T == 0
    return pairs


def alike(sketches):
    """The number of positions (under 256) in which each two sketches agree: a matrix."""
    import numpy as np

    out = np.empty((len(sketches), len(sketches)), np.uint8)
    step = max(1, (1 << 16) // len(sketches))
    for at in range(0, len(sketches), step):
        out[at : at + step] = (sketches[at : at + step, None, :] == sketches[None, :, :]).sum(2, dtype=np.uint8)
    return out


def overlaps(sets: list):
    """The sizes of the intersections of all pairs of sorted sets, by blocks of their shared elements."""
    import numpy as np

    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    use = shared[inverse]
    column, owner = number[inverse[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(shared.sum()), 4096):
        x, y = np.searchsorted(column, [lo, lo + 4096])
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[x:y], column[x:y] - lo] = 1
        out += m @ m.T
    return out


def links(docs: DataFrame, classes: DataFrame, leaves: DataFrame, least: int, linked: Callable, shingles: Callable, width: int = SKETCH, tile: int = TILE) -> DataFrame:
    """sid, root, links: within each tile, from exact sets.

    docs: the rows, found by row_key; classes: as classes_of (sketches of `width` positions); leaves: sid, key and the key's count. Pairs that
    agree in fewer than `least` positions are not compared; shingles(text) gives a set, linked(sizes of intersections, sums of the two
    sizes) tells which pairs link.
    """
    mine = leaves.groupBy("sid").agg(F.collect_list(F.struct("key", F.ceil(F.col("count") / tile).cast("int").alias("blocks"))).alias("in"))  # as many as runs and branches give
    members = mine.join(classes.select("sid", "sketch"), "sid").withColumn("at", F.explode("in")).select("sid", "sketch", F.col("in.key").alias("keys"), "at.key", "at.blocks")
    members = members.withColumn("block", F.pmod(F.xxhash64("sid"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")}).withColumn("tile", F.xxhash64("key", "a", "b"))
    tiles = members.select("tile", "key", "a", "b", "block", "sid", "keys", "sketch").repartition("tile").sortWithinPartitions("tile")

    def by_sketch(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch, bounds in tiles_of(batches):
            members = members_of(batch)
            sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, width)
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi in zip(bounds.tolist(), [*bounds[1:].tolist(), batch.num_rows]):
                if hi - lo > 1:
                    pairs = owned(alike(sketches[lo:hi]) >= least, lo, hi, members)
                    keep[lo:hi] = pairs.any(0) | pairs.any(1)
            yield batch.drop_columns(["sketch"]).filter(pa.array(keep))

    member = "tile long, key long, a int, b int, block int, sid long, keys array<long>"
    close = settled(tiles.mapInArrow(by_sketch, member), "close")
    wanted = close.select("sid").distinct().join(classes.select("sid", "row", "set_a", "set_b"), "sid")

    def texts(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            named = zip(pdf["sid"], zip(pdf["set_a"], pdf["set_b"]), pdf["text"])
            sets = [(sid, x.tobytes()) for sid, name, t in named if set_ids(x := shingles(t)) == name]
            yield pd.DataFrame(sets, columns=["sid", "elements"])

    read = docs.select(row_key().alias("row"), "text").join(wanted, "row").select("sid", "set_a", "set_b", "text")
    sets = read.mapInPandas(texts, "sid long, elements binary").groupBy("sid").agg(F.any_value("elements").alias("elements"))

    schema = "sid long, root long, links long"

    def exact(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch, bounds in tiles_of(batches, 64):
            members, sids = members_of(batch), batch.column("sid").to_numpy()
            for lo, hi in zip(bounds.tolist(), [*bounds[1:].tolist(), batch.num_rows]):
                if hi - lo < 2:
                    continue
                held = [np.frombuffer(x, np.uint64) for x in batch.column("elements").slice(lo, hi - lo).to_pylist()]
                n = np.array(list(map(len, held)), np.int64)
                pairs = owned(linked(overlaps(held).astype(np.int64), n[:, None] + n), lo, hi, members)
                if not pairs.any():
                    continue
                pairs |= pairs.T
                sid, count, root = sids[lo:hi], pairs.sum(1), np.arange(hi - lo)
                while True:
                    new = np.minimum(root, np.where(pairs, root[None, :], hi - lo).min(1))
                    new = new[new]
                    if (new == root).all():
                        break
                    root = new
                some = count > 0
                yield pa.RecordBatch.from_pydict({"sid": sid[some], "root": sid[root[some]], "links": count[some].astype(np.int64)})

    return settled(close.join(sets, "sid").repartition("tile").sortWithinPartitions("tile").mapInArrow(exact, schema), "links")


def components(edges: DataFrame) -> DataFrame:
    """sid and label for every end of edges(sid, root): equal labels within a component. Rounds of hooking and pointer jumping."""
    both = edges.select("sid", "root").union(edges.select(F.col("root").alias("sid"), F.col("sid").alias("root"))).distinct()
    both = settled(both, "edges")
    labels = settled(both.groupBy("sid").agg(F.min(F.least("sid", "root")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("sid").alias("root"), F.col("label").alias("theirs")), "root").groupBy("sid").agg(F.min("theirs").alias("theirs"))
        hooked = labels.join(near, "sid").select("sid", "label", F.least("label", "theirs").alias("new"))
        to = labels.select(F.col("sid").alias("new"), F.col("label").alias("jump"))
        labels = settled(hooked.join(to, "new").select("sid", F.least("new", "jump").alias("label"), (F.least("new", "jump") != F.col("label")).alias("changed")), "labels")
        if not labels.where("changed").take(1):
            return labels.select("sid", "label")
        labels = labels.select("sid", "label")


def _named(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """The rows of sets_of, and for each class: sid, doc_id and row (of its row with the smallest id, null last), n_copies, n_links, label (of its group)."""
    rows = settled(sets_of(docs), "sets")
    classes = classes_of(rows)
    linked = lambda both, sizes: both >= similarity * (sizes - both) - 1e-9
    found = links(docs, classes, buckets(classes.where("n > 0"), runs_for(similarity)), least_shared(similarity), linked, lambda text: shingler().shingles(text))
    grouped = found.groupBy("sid").agg(F.sum("links").alias("n_links")).join(components(found), "sid", "left")
    named = classes.select("set_a", "set_b", "sid", "doc_id", "row", "n_copies").join(grouped, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    return rows, settled(named, "named")


def join(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, group_id, n_copies (documents of the class), n_links (other classes linked) of every row of docs(doc_id, text)."""
    rows, named = _named(docs, similarity)
    linked = named.where(F.col("n_links").isNotNull())
    groups = linked.groupBy("label").agg(F.min("doc_id").alias("group_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # merged, not broadcast: salted rows are small on disk only
    linked = linked.withColumn("salt", F.pmod(F.xxhash64("sid"), F.lit(SALTS)).cast("int")).join(groups.hint("merge"), ["label", "salt"])
    every = named.where(F.col("n_links").isNull()).withColumn("group_id", F.col("doc_id")).unionByName(linked.drop("salt"))
    names = every.select(F.col("set_a").alias("sid"), F.col("set_b").alias("check"), F.col("doc_id").alias("class_id"), "group_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.select("doc_id", "sid", "check").join(names, ["sid", "check"]).select("doc_id", "class_id", "group_id", "n_copies", "n_links")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stay: one of each group, with the smallest id (null last, then by set), with its columns."""
    _, named = _named(docs, similarity)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sid", "row"))
    key = max(["kept_row", *docs.columns], key=len) + "_"  # longer than any column of docs
    kept = named.groupBy("label").agg(first.alias("first")).select(F.col("first.row").alias(key), F.col("first.doc_id").alias(f"{key}id"))
    same = (row_key() == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(f"{key}id"))  # the hash alone would name two rows of 2^64 alike
    return docs.join(kept, same).dropDuplicates([key, f"{key}id"]).drop(key, f"{key}id")
