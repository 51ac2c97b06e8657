"""Chunks that arrive as files: each micro-batch adds the rows whose key is not there yet."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sievework.operators.upsert import one_each
from sievework.sources.tables import exists

#: Buckets of keys; a batch reads those that its own keys fall into.
BUCKETS = 512


def ingest(spark: SparkSession, source: str, schema: str | StructType, target: str, state: str, keys: list[str], forever: bool = False, buckets: int = BUCKETS) -> StreamingQuery:
    """Reads Parquet files as they come into `source` and keeps one row of each key in `target`, a folder of one part for each batch.

    The keys that are there stand by themselves in state/keys, in folders by a hash of the key, and only the folders of the batch's own
    keys are read. A batch that is run again after a failure overwrites its part and its keys, so that no row is there twice; rows and
    keys of a batch that did not end are not seen by it. `buckets` stays the same for a target.
    """
    index = f"{state}/keys"

    def add(batch: DataFrame, number: int) -> None:
        rows = one_each(batch, keys, last=False).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        if exists(spark, index):
            mine = [r.bucket for r in rows.select("bucket").distinct().collect()]  # no more than there are buckets
            there = known_keys(spark, index, batch.select(*keys).schema, mine, number)
            rows = rows.join(there, keys, "left_anti").select(*batch.columns, "bucket")
        rows.drop("bucket").write.mode("overwrite").parquet(f"{target}/batch={number}")
        new = spark.read.schema(batch.schema).parquet(f"{target}/batch={number}").select(*keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), F.lit(number).cast("long").alias("batch"))
        new.repartition("bucket", "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(index)

    stream = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(add).option("checkpointLocation", f"{state}/stream")
    return stream.start() if forever else stream.trigger(availableNow=True).start()


def known_keys(spark: SparkSession, index: str, keys: StructType, buckets: list[int], before: int) -> DataFrame:
    """The keys of some buckets that batches before one have added; other buckets' folders are not opened."""
    schema = StructType([*keys.fields, *StructType.fromDDL("bucket int, batch long").fields])
    return spark.read.schema(schema).parquet(index).where(F.col("bucket").isin(buckets) & (F.col("batch") < before)).select(*keys.names)
