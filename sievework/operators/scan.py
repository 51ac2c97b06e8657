"""Running numbers and values carried down over all rows in one order, without one task for all rows.

Rows are ranged by the order and written; each part counts its rows and finds its last filled values; what stands before a part follows
from these few figures, one row for each part, and is added to what a window within the part gives.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.sources.tables import settled


def scanned(df: DataFrame, order: Sequence[str], number: str | None = None, carried: dict[str, str] | None = None) -> DataFrame:
    """df with a column `number` (places from 1) and, for each new column in `carried`, the last value of its source in the rows above
    (that row not included) that is not null. Equal rows in the order get their places in no set order; nulls come first."""
    carried = carried or {}
    ranged = settled(df.repartitionByRange(*order).withColumn("part_", F.spark_partition_id()), "ranged")
    last = {c: F.max_by(source, F.when(F.col(source).isNotNull(), F.struct(*order))) for c, source in carried.items()}
    parts = ranged.groupBy("part_").agg(F.count(F.lit(1)).alias("rows_"), *[x.alias(f"last_{i}") for i, x in enumerate(last.values())])
    before, n, held = [], 0, [None] * len(carried)
    for part in sorted(parts.collect(), key=lambda r: r.part_):  # one row for each task's part
        before.append((part.part_, n, *held))
        n += part.rows_
        held = [h if x is None else x for h, x in zip(held, part[2:])]
    kinds = [f"above_{i} {df.schema[source].dataType.simpleString()}" for i, source in enumerate(carried.values())]
    above = df.sparkSession.createDataFrame(before, ", ".join(["part_ int", "before_ long", *kinds]))
    within = Window.partitionBy("part_").orderBy(*order)
    up = within.rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(above.hint("broadcast"), "part_")
    out = out.withColumns({c: F.coalesce(F.last(source, ignorenulls=True).over(up), F.col(f"above_{i}")) for i, (c, source) in enumerate(carried.items())})
    if number:
        out = out.withColumn(number, F.col("before_") + F.row_number().over(within))
    return out.select(*df.columns, *carried, *([number] if number else []))
