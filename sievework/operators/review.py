"""Small group summaries of labels."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    return rows.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count(F.lit(1)).alias("n"))


def mode(rows: DataFrame, by: str, value: str) -> DataFrame:
    """The commonest value of each group, ties to the smaller; counted before the window, so it sees few rows."""
    order = Window.partitionBy(by).orderBy(F.desc("n"), value)
    counts = rows.groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")
