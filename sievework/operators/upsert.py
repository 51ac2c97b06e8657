"""Keyed writes as DataFrame functions: the caller writes the result to a new path and swaps.

A batch may hold a key several times: `order`, a column, says which row counts (else all columns, so that the choice is the same in each
run). It may have fewer columns than the table, whose other columns are then null in its rows. Without keys a batch is appended.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_each(batch: DataFrame, keys: list[str], order: str | None = None, last: bool = True) -> DataFrame:
    """The last (or first) row of each key."""
    columns = [order] if order else [c for c in batch.columns if c not in keys] or keys
    by = [F.desc_nulls_last(c) if last else F.asc_nulls_first(c) for c in columns]
    return batch.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_k = 1").drop("_k")


def _shaped(old: DataFrame, batch: DataFrame) -> DataFrame:
    return batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns])


def append(old: DataFrame, batch: DataFrame) -> DataFrame:
    return old.unionByName(_shaped(old, batch))


def replace(old: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows of the batch win over old rows of the same key; of several in the batch the last."""
    if not keys:
        return append(old, batch)
    batch = one_each(batch, keys, order)
    return append(old.join(batch.select(*keys), keys, "left_anti").select(*old.columns), batch)


def insert_absent(old: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Old rows win over rows of the batch; of several in the batch the first."""
    if not keys:
        return append(old, batch)
    batch = one_each(batch, keys, order, last=False)
    return append(old, batch.join(old.select(*keys), keys, "left_anti"))


def fill_missing(old: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], order: str | None = None) -> DataFrame:
    """Insert-if-absent that also fills nulls of some columns of old rows. One full join on the keys."""
    batch = one_each(batch, keys, order, last=False)
    both = old.withColumn("_old", F.lit(True)).alias("o").join(_shaped(old, batch).alias("b"), keys, "full")
    value = {c: F.coalesce(f"o.{c}", f"b.{c}") if c in columns else F.when(F.col("o._old"), F.col(f"o.{c}")).otherwise(F.col(f"b.{c}")) for c in old.columns if c not in keys}
    return both.select(*[F.col(c) if c in keys else value[c].alias(c) for c in old.columns])


def update(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """old with the columns of changes set where the key is there, to null too; nothing is added. changes: one row a key."""
    columns = [c for c in changes.columns if c not in keys]
    c = changes.select(*keys, *[F.col(x).alias(f"_new_{x}") for x in columns], F.lit(True).alias("_hit"))
    out = old.join(c, keys, "left")
    return out.select(*[F.when(F.col("_hit"), F.col(f"_new_{x}")).otherwise(F.col(x)).alias(x) if x in columns else F.col(x) for x in old.columns])


def delete(old: DataFrame, column: str, value) -> DataFrame:
    """old without the rows of a value; rows where the column is null stay."""
    return old.where(~F.col(column).eqNullSafe(F.lit(value)))


def delete_with_orphans(works: DataFrame, links: DataFrame, entity) -> tuple[DataFrame, DataFrame]:
    """(works, links) without an entity's links, and without the works that only it was linked to."""
    left = delete(links, "entity_id", entity)
    gone = links.where(F.col("entity_id") == F.lit(entity)).select("work_id").distinct().join(left.select("work_id"), "work_id", "left_anti")
    return works.join(gone, "work_id", "left_anti"), left
