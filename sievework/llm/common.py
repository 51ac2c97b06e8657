"""What the operators of this package share: tables, scratch space, Arrow batches and groups of sorted rows."""

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows that are handled together. Texts may be very long, so batches stay small.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder. Queries read through this; it makes the session's Arrow batches as small as BATCH_ROWS."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(df: DataFrame, make: Callable, schema: str | StructType) -> DataFrame:
    """df.mapInArrow, `make` getting the batches cut to BATCH_ROWS. Columns that it passes on are not converted, so that ids stay exact."""

    def small(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield batch.slice(at, BATCH_ROWS)

    return df.mapInArrow(lambda batches: make(small(batches)), schema)


def arrow_rows(rows: list[tuple], schema: str, **given):
    """A record batch of a schema like "a long, b string": some columns as given arrays, the others from tuples in their order."""
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    left = [name for name, _ in fields if name not in given]
    values = dict(zip(left, zip(*rows) if rows else [()] * len(left)))
    return pa.RecordBatch.from_arrays([given[name] if name in given else pa.array(values[name], kinds[kind]) for name, kind in fields], names=[name for name, _ in fields])


def kept_rows(df: DataFrame, column: str, keep: Callable) -> DataFrame:
    """The rows of df for whose value of `column` keep(value) is true, with all their columns."""

    def filtered(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([keep(x) for x in batch.column(column).to_pylist()], pa.bool_()))

    return in_batches(df, filtered, StructType(df.schema.fields))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir). Only a local session may have none set."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/sievework-{name}-{uuid.uuid4().hex}"


def until_exit(spark: SparkSession, path: str) -> None:
    """Marks a written path to be removed when the driver ends; results are read from it until then."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, which cuts its lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    until_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def grouped(batches, key: str):
    """Groups of equal `key` from batches that are sorted by it; a group may span batches, and must fit in memory."""
    import pandas as pd

    rest = []
    for pdf in batches:
        if not len(pdf):
            continue
        starts = [0, *(i for i, new in enumerate(pdf[key].to_numpy()[1:] != pdf[key].to_numpy()[:-1], 1) if new), len(pdf)]
        for a, b in zip(starts, starts[1:]):
            part = pdf.iloc[a:b]
            if rest and rest[-1][key].iloc[0] != part[key].iloc[0]:
                yield pd.concat(rest, ignore_index=True)
                rest = []
            rest.append(part)
    if rest:
        yield pd.concat(rest, ignore_index=True)
