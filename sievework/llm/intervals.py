"""Overlap join of the sales of a client with its click sessions, by the relation of the two intervals.

Intervals are compared in slots of SLOT microseconds, both ends inclusive; an open end is infinite. Both sides are cut by client and
SHARD slots of time: an interval lies in the shard of its start, and a long one also in each later shard, up to its end, in which an
interval of the other side starts for its client (so open ends cost no more shards than the client has). A shard is swept forward over
starts: of a pair, the one that starts later must start in the shard, and is met by the other there alone, so each pair is formed once.
Shards of more than BLOCK rows of a side are cut into blocks of it, and every block meets every block of the other side. A task holds one
pair of blocks at a time and gives sums for each sale and relation, never pairs.

Sessions come without sorting clicks: clicks of one client within the same GAP of the clock are always in one session, so they are first
summed to a row for each such cell, of which a client has no more than time has cells.

Rows with a null client or time take no part, and a client without partners gives no rows. Repeated clicks and lines change nothing; lines
without a sale are ignored; a sale without lines ends when it was sold. Rows of sales that share a sale_id (none in the given tables, or
null ids) each take part, and their sums are added up. Empty tables give no rows. Other columns are not read. Times are read as wall clock
when they have no zone, else in the session's.
"""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled
from .jaccard import tiles_of

SLOT, GAP = 3_600_000_000, 600_000_000
#: Slots in a shard, rows of a side in a block, and pairs that a sweep forms at once.
SHARD, BLOCK, PAIRS = 168, 4096, 1 << 18
#: The slot of an open end.
OPEN = (1 << 31) - 1
RELATIONS = ("overlaps", "finished_by", "contains", "starts", "equals", "started_by", "during", "finishes", "overlapped_by")


def micros(time: str) -> Column:
    """Whole microseconds since 1970 of a time's wall clock."""
    parts = f"unix_date(CAST({time} AS DATE)) * 86400000000L + (hour({time}) * 3600 + minute({time}) * 60) * 1000000L + CAST(extract(SECOND FROM {time}) * 1000000 AS BIGINT)"
    return F.expr(parts)


def floored(x: Column, by: int) -> Column:
    """x divided by a whole number and rounded down, exactly."""
    return F.call_function("div", x - F.pmod(x, F.lit(by)), F.lit(by))


def sessions(clicks: DataFrame, gap: int = GAP) -> DataFrame:
    """client_id, first, last (microseconds) and is_open of the sessions of clicks(client_id, ts, kind)."""
    rows = clicks.where("client_id IS NOT NULL AND ts IS NOT NULL").select("client_id", micros("ts").alias("at"), F.coalesce(F.col("kind") == "purchase", F.lit(False)).alias("bought"))
    cells = rows.groupBy("client_id", floored(F.col("at"), gap).alias("cell")).agg(F.min("at").alias("first"), F.max(F.struct("at", "bought")).alias("end"))
    order = Window.partitionBy("client_id").orderBy("cell")
    began = F.coalesce(F.col("first") - F.lag("end.at").over(order) > gap, F.lit(True))
    named = cells.withColumn("began", F.when(began, F.col("first"))).withColumn("session", F.max("began").over(order))
    return named.groupBy("client_id", F.col("session").alias("first")).agg(F.max("end").alias("end")).select("client_id", "first", F.col("end.at").alias("last"), F.col("end.bought").alias("is_open"))


def sale_intervals(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """sale_id, client_id, first, last and is_open of sales(sale_id, client_id, sold_at) and lines(sale_id, shipped_at)."""
    sent = lines.where("sale_id IS NOT NULL").groupBy("sale_id").agg(F.max(micros("shipped_at")).alias("sent"), F.max(F.col("shipped_at").isNull()).alias("waits"))
    sold = sales.where("client_id IS NOT NULL AND sold_at IS NOT NULL").select("sale_id", "client_id", micros("sold_at").alias("first"))
    return sold.join(sent.hint("merge"), "sale_id", "left").select("sale_id", "client_id", "first", F.greatest("first", "sent").alias("last"), F.coalesce("waits", F.lit(False)).alias("is_open"))


def _sided(intervals: DataFrame, side: int, name: Column, value: Column) -> DataFrame:
    start, end = floored(F.col("first"), SLOT), F.when(F.col("is_open"), F.lit(OPEN).cast("long")).otherwise(floored(F.col("last"), SLOT))
    return intervals.select("client_id", F.lit(side).alias("side"), name.cast("long").alias("name"), value.cast("long").alias("value"), start.alias("a"), end.alias("b")).withColumn("home", floored(F.col("a"), SHARD))


def relations(sales: DataFrame, clicks: DataFrame, block: int = BLOCK) -> DataFrame:
    """sale_id, relation, n_pairs, overlap_slots, sessions_crc. sales and clicks are intervals: (sale_id,) client_id, first, last, is_open."""
    both = _sided(sales, 0, F.col("sale_id"), F.lit(0)).unionByName(_sided(clicks, 1, F.lit(0), F.crc32(F.col("first").cast("string").cast("binary"))))
    both = settled(both, "intervals")
    # for each client, the shards in which intervals of a side start: as many as time has; written, so that the join can split a hot client
    occupied = settled(both.groupBy("client_id").agg(*[F.array_sort(F.collect_set(F.when(F.col("side") == s, F.col("home")))).alias(f"of_{s}") for s in (0, 1)]), "occupied")
    placed = both.join(occupied.hint("merge"), "client_id")
    partners = F.when(F.col("side") == 0, F.col("of_1")).otherwise(F.col("of_0"))
    later = F.filter(partners, lambda x: (x > F.col("home")) & (x <= floored(F.col("b"), SHARD)))
    placed = placed.where(F.size(partners) > 0).withColumn("shard", F.explode(F.concat(F.array("home"), later)))
    placed = settled(placed.select("client_id", "shard", "side", "name", "value", "a", "b", (F.col("shard") == F.col("home")).alias("starts")), "placed")
    sizes = settled(placed.groupBy("client_id", "shard").agg(*[F.sum((F.col("side") == s).cast("long")).alias(f"n_{s}") for s in (0, 1)]).where("n_0 > 0 AND n_1 > 0"), "sizes")
    blocks = [F.ceil(F.col(f"n_{s}") / block).cast("int") for s in (0, 1)]
    mine, others = F.when(F.col("side") == 0, blocks[0]).otherwise(blocks[1]), F.when(F.col("side") == 0, blocks[1]).otherwise(blocks[0])
    dealt = placed.join(sizes.hint("merge"), ["client_id", "shard"]).withColumn("own", F.pmod(F.xxhash64("side", "name", "value", "a", "b"), mine).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    pair = F.when(F.col("side") == 0, F.struct(F.col("own").alias("i"), F.col("other").alias("j"))).otherwise(F.struct(F.col("other").alias("i"), F.col("own").alias("j")))
    tiles = dealt.withColumn("pair", pair).select("client_id", "shard", "pair.i", "pair.j", F.xxhash64("client_id", "shard", "pair.i", "pair.j").alias("tile"), "side", "name", "value", "a", "b", "starts")
    keys = ["tile", "client_id", "shard", "i", "j"]
    swept = tiles.repartition(*keys).sortWithinPartitions(*keys, "side", "a").mapInArrow(sweep, "sale_id long, kind int, n_pairs long, slots long, crc long")
    sums = swept.groupBy("sale_id", "kind").agg(F.sum("n_pairs").alias("n_pairs"), F.sum("slots").alias("overlap_slots"), F.sum("crc").alias("sessions_crc"))
    return sums.select("sale_id", F.element_at(F.array(*map(F.lit, RELATIONS)), F.col("kind") + 1).alias("relation"), "n_pairs", "overlap_slots", "sessions_crc")


def sweep(batches: Iterator) -> Iterator:
    """Sums for each sale and relation, from batches of tiles; within a tile, rows are sorted by side and start."""
    import numpy as np
    import pyarrow as pa

    for batch, _ in tiles_of(batches):
        of = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "client_id", "shard", "i", "j", "side", "value", "a", "b", "starts")}
        new = np.ones(batch.num_rows, bool)
        same = np.ones(batch.num_rows - 1, bool)
        for c in ("tile", "client_id", "shard", "i", "j"):
            same &= of[c][1:] == of[c][:-1]
        new[1:] = ~same
        tile = np.cumsum(new) << 33  # above any slot
        sale, click = of["side"] == 0, of["side"] == 1
        names = batch.column("name").filter(pa.array(sale))
        s = {c: of[c][sale] for c in ("a", "b", "starts")} | {"tile": tile[sale]}
        c = {k: of[k][click] for k in ("a", "b", "starts", "value")} | {"tile": tile[click]}
        shift = 1 << 31
        n, sums = len(s["a"]), np.zeros((3, len(s["a"]) * len(RELATIONS)), np.int64)

        def meet(left: dict, right: dict, strict: bool):
            """(rows of left, rows of right): right starts in the shard, within left's span, later than left's start if strict."""
            at = np.flatnonzero(right["starts"])
            keys = (right["tile"] + right["a"] + shift)[at]  # ascending, as rows are sorted
            lo = np.searchsorted(keys, left["tile"] + left["a"] + shift, "right" if strict else "left")
            hi = np.searchsorted(keys, left["tile"] + left["b"] + shift, "right")
            ends = np.cumsum(np.maximum(hi - lo, 0))
            done = 0
            while done < len(ends):
                upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS)))
                count = np.maximum(hi - lo, 0)[done:upto]
                rows = np.repeat(np.arange(done, upto), count)
                first = np.repeat(lo[done:upto] - np.cumsum(np.append(0, count[:-1])), count)
                yield rows, at[first + np.arange(len(rows))]
                done = upto

        def add(i, j) -> None:
            sa, sb, ca, cb = s["a"][i], s["b"][i], c["a"][j], c["b"][j]
            kind = 3 * (1 + np.sign(sa - ca)) + 1 + np.sign(sb - cb)
            slots = np.where((sb == OPEN) & (cb == OPEN), 0, np.minimum(sb, cb) - np.maximum(sa, ca) + 1)
            bins = i * len(RELATIONS) + kind
            for row, weights in zip(sums, (None, slots, c["value"][j])):
                row += np.bincount(bins, weights, len(row)).astype(np.int64)  # exact: 2^18 values under 2^32

        if n and len(c["a"]):
            for i, j in meet(s, c, False):
                add(i, j)
            for j, i in meet(c, s, True):
                add(i, j)
        at = np.flatnonzero(sums[0])
        both = (s["b"][at // len(RELATIONS)] == OPEN) & np.isin(at % len(RELATIONS), (1, 4, 7))
        slots = pa.array(sums[1][at], pa.int64(), mask=both)
        yield pa.RecordBatch.from_arrays([names.take(pa.array(at // len(RELATIONS))), pa.array((at % len(RELATIONS)).astype(np.int32)), pa.array(sums[0][at]), slots, pa.array(sums[2][at])], names=["sale_id", "kind", "n_pairs", "slots", "crc"])


def join(sales: DataFrame, lines: DataFrame, clicks: DataFrame) -> DataFrame:
    """What relations gives for the tables of a shop."""
    return relations(sale_intervals(sales, lines), sessions(clicks))
