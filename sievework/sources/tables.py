"""Tables of a data folder, and folders for what a query writes."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir). Only a local session may have none set."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/sievework-{name}-{uuid.uuid4().hex}"


def until_exit(spark: SparkSession, path: str) -> str:
    """Marks a written path to be removed when the driver ends; results are read from it until then."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, so that it is computed once and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    until_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something stands at a path, asked of its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def renamed(spark: SparkSession, old: str, new: str) -> None:
    """Gives a path another name on its file system; a name that is taken is an error."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (old, new))
    system = b.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(b):
        raise FileExistsError(new)
    if b.getParent() is not None:
        system.mkdirs(b.getParent())
    if not system.rename(a, b):
        raise OSError(f"{old} could not be renamed to {new}")


def held(df: DataFrame, most: int = 20_000) -> DataFrame:
    """A list that is small by its nature (a vocabulary, a row for each attribute) as rows that go to every task, so that the rows it is
    joined to need not move to a few keys. It is computed once, here; one of more than `most` rows is given back as it is, for a shuffle."""
    rows = df.limit(most + 1).collect()
    return df if len(rows) > most else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by its keys in as many parts as the session shuffles into. Unlike those of a plain shuffle they are not merged by their size on
    disk, which says little of rows that compress very well: a task's sorts and windows would grow with the table."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
