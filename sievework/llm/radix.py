"""The first k rows of each group, by value descending and then by item in the order of its UTF-8 bytes, found by radix selection.

Each round counts, for each group, the rows by the next digit: DIGIT bits of the value from its highest used bit, then PREFIX bytes of
the item. The digit in which the k-th row lies follows from these counts, of which a group has no more than a digit has values. Rows
before that digit are taken, rows in it go to the next round; no rows are sorted or gathered but the k that are left.

Values are whole and not negative, null values take no part, a null item counts as empty; rows that are equal in both are kept up to k.
Nulls in group columns are a group. An empty table gives no rows. Other columns are kept.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

DIGIT, PREFIX = 12, 2


def _digits(rows: DataFrame, value: str, item: str) -> list[Column]:
    """The digits of a row, the most significant first; the row with the smallest digits comes first."""
    most = rows.agg(F.max(value).alias("value"), F.max(F.octet_length(item)).alias("bytes")).first()
    bits = max(1, int(most["value"] or 0).bit_length())
    low = [max(0, bits - DIGIT * (n + 1)) for n in range(-(-bits // DIGIT))]  # the last may repeat bits of the one before
    of_value = [F.lit(1 << DIGIT) - F.shiftright(F.col(value), at).bitwiseAND((1 << DIGIT) - 1) for at in low]
    text = F.coalesce(F.col(item).cast("string"), F.lit("")).cast("binary")
    # the bytes at a place as a number; beyond the end they count as 0, below any byte, as each is raised by one
    raised = lambda at: F.coalesce(F.conv(F.hex(F.substring(text, at, 1)), 16, 10).cast("int") + 1, F.lit(0))
    of_item = [reduce(lambda x, at: x * 257 + raised(at), range(at, at + PREFIX), F.lit(0)) for at in range(1, (most["bytes"] or 0) + 1, PREFIX)]
    return [*of_value, *of_item]


def first_k(rows: DataFrame, groups: Sequence[str], value: str, item: str, k: int) -> DataFrame:
    """The first k rows of each group, with their column rank (from 1)."""
    mine = [F.col(c).alias(f"of_{n}") for n, c in enumerate(groups)]
    rows = settled(rows.where(F.col(value).isNotNull()), "ranked")
    taken, open_rows, wanted = [], rows, F.lit(k)
    for digit in _digits(rows, value, item):
        open_rows = open_rows.withColumn("digit_", digit.cast("long"))
        counts = open_rows.groupBy(*groups, "digit_").agg(F.count(F.lit(1)).alias("n_"), F.max(wanted).alias("wanted_"))
        upto = F.sum("n_").over(Window.partitionBy(*groups).orderBy("digit_"))
        state = counts.withColumn("upto_", upto).where("upto_ - n_ < wanted_")  # digits before the k-th row's, and that itself
        state = settled(state.select(*mine, F.col("digit_").alias("at_"), (F.col("upto_") <= F.col("wanted_")).alias("whole_"), (F.col("wanted_") - F.col("upto_") + F.col("n_")).alias("left_")), "digits")
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"of_{n}")) for n, c in enumerate(groups)], F.col("digit_") == F.col("at_"))
        met = settled(open_rows.drop("wanted_").join(state, same).drop(*[f"of_{n}" for n in range(len(groups))], "at_", "digit_"), "met")
        taken.append(met.where("whole_").drop("whole_", "left_"))
        open_rows, wanted = met.where("NOT whole_").withColumnRenamed("left_", "wanted_").drop("whole_"), F.col("wanted_")
        if not open_rows.take(1):
            break
    else:  # rows that are equal to the last byte: as many as are still wanted
        order = Window.partitionBy(*groups).orderBy(F.lit(0))
        taken.append(open_rows.withColumn("n_", F.row_number().over(order)).where("n_ <= wanted_").drop("n_", "wanted_"))
    few = reduce(DataFrame.unionByName, taken)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc(value), F.coalesce(F.col(item).cast("string"), F.lit("")))))
