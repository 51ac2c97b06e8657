"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact distances.

Each of TABLES tables hashes a vector by HASHES Gaussian projections cut into cells of a width. A query visits its own bucket and the
PROBES - 1 perturbed ones with the least sum of squared distances to the cell borders it would cross. The vectors and the queries of a
bucket are both cut into blocks of bounded size; each pair of blocks gives its queries' nearest k + 1, and the tables' lists are merged.
Queries that find fewer than k are compared with all vectors, in blocks too. Equal vectors form one class that carries its k + 1 smallest
ids, which is all that can count; a row that is there twice counts once.

The width comes from a sample of SAMPLE vectors; every vector is indexed, in double precision. Vectors are searched among those of their
own length, which has its own projections and width and is part of every key. Vectors null, empty, zero, or with null or non-finite components take no part,
and neither do null ids. Ties go to the smaller id. An id that stands with several vectors is a query with each of them, whose answers are
merged, and a candidate with each; in an answer it counts once, at its nearest. An empty table, or none with a query, gives no rows.
Columns but the id and the vector are not read.
"""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import grouped, settled

TABLES, HASHES, PROBES, WIDTH, SAMPLE, SEED = 5, 5, 24, 1.5, 2000, 11
#: Vectors and queries in a block, and buckets of more than a block that may be broadcast with their numbers of blocks (more are joined).
BLOCK, QUERIES, HEAVY = 512, 256, 100_000
#: Vectors in a block of the search of all.
WIDE = 1 << 15
PAIRS = "query long, class long, least long, score double"
MEMBER = "kind int, node long, least long, vector array<double>, width double"


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id and vector of the distinct rows that take part."""
    e = F.col("vector")
    good = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
    return rows.where(F.col("id").isNotNull() & e.isNotNull() & good).withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))).distinct()


def classes_of(rows: DataFrame, keep: int) -> DataFrame:
    """A row for each distinct vector: class (a number), least (its smallest id), ids (the `keep` smallest, ascending) and the vector."""
    smallest = Window.partitionBy("vector").orderBy("id")
    few = rows.select("id", "vector").withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= keep)
    return few.groupBy("vector").agg(F.min("id").alias("least"), F.array_sort(F.collect_list("id")).alias("ids")).withColumn("class", F.monotonically_increasing_id())


class Hashing:
    """The projections, and the cells of vectors and of probes."""

    def __init__(self, dimensions: int, width: float, seed: int = SEED):
        import itertools

        import numpy as np

        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(TABLES, dimensions, HASHES))
        self.b = rng.uniform(0, 1, (TABLES, HASHES))
        self.width = width
        self.moves = np.array(list(itertools.product((0, -1, 1), repeat=HASHES)))

    def at(self, x, t: int):
        import numpy as np

        return np.clip(x @ self.a[t] / self.width + self.b[t], -1e15, 1e15)

    @staticmethod
    def key(cells, t: int, dimensions: int):
        import numpy as np

        out = np.full(cells.shape[:-1], t + 1 + TABLES * dimensions, np.int64)
        for m in range(cells.shape[-1]):
            out = out * np.int64(1_000_003) + cells[..., m].astype(np.int64)
        return out

    def buckets(self, x, t: int):
        import numpy as np

        return self.key(np.floor(self.at(x, t)), t, x.shape[1])

    def probes(self, x, t: int, n: int):
        """The keys of the n likeliest buckets of each query, likeliest first."""
        import numpy as np

        at = self.at(x, t)
        cell = np.floor(at)
        low = at - cell
        cost = np.zeros((len(x), len(self.moves)))
        for m in range(HASHES):
            move = self.moves[:, m]
            cost += np.where(move == -1, low[:, m : m + 1] ** 2, np.where(move == 1, (1 - low[:, m : m + 1]) ** 2, 0))
        best = np.argsort(cost, 1, kind="stable")[:, :n]
        return self.key(cell[:, None, :] + self.moves[best], t, x.shape[1])


def nearest(queries: list, classes, least, x, found: list, k: int) -> None:
    """Appends (query, class, its least id, distance) of each query's k nearest of the rows x, ties to the smaller least id."""
    import numpy as np

    for query, q in queries:
        with np.errstate(over="ignore"):
            d = np.sqrt(((x - q) ** 2).sum(1))
        top = np.arange(len(d)) if len(d) <= k else np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        found.extend((query, int(classes[i]), int(least[i]), float(d[i])) for i in top[np.lexsort((least[top], d[top]))][:k])


def widths(classes: DataFrame, k: int) -> DataFrame:
    """length and width: the cell width for the vectors of each length, from a bounded sample of them."""

    def width(pdf):
        import numpy as np
        import pandas as pd

        x = np.stack(pdf["vector"]).astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (x * x).sum(1) - 2 * x @ x.T, 0))
        d.sort(1)
        typical = float(np.median(d[:, min(k, len(x) - 1)]))
        return pd.DataFrame({"length": [x.shape[1]], "width": [WIDTH * (typical if 0 < typical < float("inf") else 1.0)]})

    drawn = Window.partitionBy("length").orderBy(F.xxhash64("vector"), "class")
    sample = classes.select(F.size("vector").alias("length"), "vector", "class").withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= SAMPLE)
    return sample.groupBy("length").applyInPandas(width, "length int, width double")


def by_length(pdf) -> Iterator:
    """(rows, their vectors as a matrix, hashing) for each length in a batch of MEMBER."""
    import numpy as np

    for length, part in pdf.groupby(pdf["vector"].map(len)):
        yield part, np.stack(part["vector"]).astype(np.float64), Hashing(int(length), float(part["width"].iloc[0]))


def search(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found. is_query is a condition on a column named id."""
    rows = usable(vectors, vec_id, embedding)
    classes = settled(classes_of(rows, k + 1), "classes")
    asked = settled(rows.where(is_query).select("id", "vector"), "asked")
    return _search(classes, asked, k)


def _compared(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """PAIRS of each query's k + 1 nearest: queries and vectors (MEMBER) meet where their column key is equal."""

    def visit(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        found: list = []
        for g in grouped(batches, "key"):
            kind = g["kind"].to_numpy()
            n = int((kind == 0).sum())
            if 0 < n < len(g) and g["vector"].map(len).nunique() == 1:
                g = g.iloc[np.argsort(kind, kind="stable")]
                x = np.stack(g["vector"]).astype(np.float64)
                node, least = g["node"].to_numpy(), g["least"].to_numpy()
                nearest(list(zip(node[:n].tolist(), x[:n])), node[n:], least[n:], x[n:], found, k + 1)
            if len(found) > 50_000:
                yield pd.DataFrame(found, columns=["query", "class", "least", "score"])
                found = []
        yield pd.DataFrame(found, columns=["query", "class", "least", "score"])

    columns = ["key", "kind", "node", "least", "vector"]
    both = queries.select(*columns).union(vectors.select(*columns))
    pairs = both.repartition("key").sortWithinPartitions("key", "kind").mapInPandas(visit, PAIRS)
    order = Window.partitionBy("query").orderBy("score", "least", "class")
    return pairs.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")


def _search(classes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """What search gives, for classes and queries asked."""
    width = settled(widths(classes, k), "widths")
    shaped = classes.withColumn("length", F.size("vector")).join(width, "length")
    kept = ["node", "least", "vector", "width"]
    distinct = settled(shaped.join(asked.select("vector").distinct(), "vector", "left_semi").select(F.lit(0).alias("kind"), F.col("class").alias("node"), *kept[1:]), "queries")
    lengths = distinct.select(F.size("vector").alias("length")).distinct()
    members = shaped.join(lengths, "length", "left_semi").select(F.lit(1).alias("kind"), F.col("class").alias("node"), *kept[1:])

    def index(batches: Iterator) -> Iterator:
        for pdf in batches:
            for part, x, hashing in by_length(pdf):
                for t in range(TABLES):
                    yield part.assign(bucket=hashing.buckets(x, t))

    def probe(batches: Iterator) -> Iterator:
        for pdf in batches:
            for part, x, hashing in by_length(pdf):
                for t in range(TABLES):
                    keys = hashing.probes(x, t, PROBES)
                    yield part.loc[part.index.repeat(keys.shape[1])].assign(bucket=keys.ravel())

    indexed, probing = members.mapInPandas(index, f"{MEMBER}, bucket long"), distinct.mapInPandas(probe, f"{MEMBER}, bucket long")
    sizes = settled(indexed.groupBy("bucket").agg(F.count(F.lit(1)).alias("vectors")).join(probing.groupBy("bucket").agg(F.count(F.lit(1)).alias("queries")), "bucket"), "buckets")
    cuts = [F.ceil(F.col("vectors") / BLOCK).cast("int").alias("v_cuts"), F.ceil(F.col("queries") / QUERIES).cast("int").alias("q_cuts")]
    heavy = settled(sizes.where((F.col("vectors") > BLOCK) | (F.col("queries") > QUERIES)).select("bucket", *cuts), "heavy")
    heavy = F.broadcast(heavy) if heavy.count() <= HEAVY else heavy.hint("merge")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """rows in one block of their own kind, once for each block of the other."""
        n = {c: F.coalesce(F.col(c), F.lit(1)) for c in (own, other)}
        rows = rows.join(heavy, "bucket", "left").withColumn(f"{own}_at", F.pmod(F.xxhash64("node"), n[own]).cast("int"))
        return rows.withColumn(f"{other}_at", F.explode(F.sequence(F.lit(0), n[other] - 1))).withColumn("key", F.xxhash64("bucket", "v_cuts_at", "q_cuts_at"))

    found = settled(_compared(dealt(probing, "q_cuts", "v_cuts"), dealt(indexed, "v_cuts", "q_cuts"), k), "found")
    ids = classes.select("class", "ids")

    def listed(pairs: DataFrame) -> DataFrame:
        return pairs.join(ids, "class").select("query", F.explode("ids").alias("vec_id"), "score").groupBy("query", "vec_id").agg(F.min("score").alias("score"))

    held = settled(listed(found), "held")
    enough = held.groupBy("query").count().where(F.col("count") > k).select(F.col("query").alias("node"))
    missing = settled(distinct.join(enough, "node", "left_anti"), "missing")
    if n := missing.count():  # queries with too few candidates, against all vectors, in blocks
        v_cuts, q_cuts = -(-classes.count() // WIDE), -(-n // QUERIES)
        at = lambda cuts: F.pmod(F.xxhash64("node"), F.lit(cuts)).cast("int")
        every = lambda cuts: F.explode(F.sequence(F.lit(0), F.lit(cuts - 1)))
        key = F.xxhash64(F.size("vector"), "v_at", "q_at").alias("key")
        asking = missing.withColumn("q_at", at(q_cuts)).withColumn("v_at", every(v_cuts)).select("*", key)
        all_of = members.withColumn("v_at", at(v_cuts)).withColumn("q_at", every(q_cuts)).select("*", key)
        more = listed(_compared(asking, all_of, k))
        held = held.join(missing.select(F.col("node").alias("query")), "query", "left_anti").union(more)
    short = held.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("n") <= k + 1)
    answers = short.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("list"))
    lists = distinct.join(answers, distinct["node"] == answers["query"]).select("vector", "list")
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    out = asked.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int")).join(salted, ["vector", "salt"]).select("id", "list")
    merged = out.groupBy("id").agg(F.flatten(F.collect_list(F.filter("list", lambda x: x["vec_id"] != F.col("id")))).alias("list"))  # lists of k + 1
    nearest_of = F.aggregate(F.array_sort("list"), F.array().cast("array<struct<score:double,vec_id:bigint>>"), lambda a, x: F.when((F.size(a) < k) & ~F.exists(a, lambda y: y["vec_id"] == x["vec_id"]), F.concat(a, F.array(x))).otherwise(a))
    out = merged.select(F.col("id").alias("query_id"), F.posexplode(nearest_of).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
