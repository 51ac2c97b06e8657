from pyspark.sql import functions as F

from sievework.operators.retrieval import bounded_carry_forward

SCHEMA = "g int, pos int, text boolean, hit boolean, other boolean"


def anchors(spark, rows, limit=3):
    df = spark.createDataFrame([(g, i, *flags) for g, table in enumerate(rows) for i, flags in enumerate(table, 1)], SCHEMA)
    got = {(r.g, r.pos): r.anchor for r in bounded_carry_forward(df, "g", "pos", F.col("text"), F.col("hit"), F.col("other"), limit).collect()}
    return [[got[g, i] for i in range(1, len(table) + 1)] for g, table in enumerate(rows)]


def test_truth_table(spark):
    plain, hit, other, figure = (True, False, False), (True, True, False), (True, False, True), (False, False, False)
    tables = [
        [hit, plain, plain, figure, plain, other, plain, plain],
        [hit, plain, plain, plain, plain, plain],
        [plain, hit, (True, True, True), plain, (False, True, True), plain, (True, None, None)],
        [hit, (False, False, True), plain, hit, plain],
    ]
    assert anchors(spark, tables) == [
        [None, 1, 1, None, 1, None, None, None],
        [None, 1, 1, 1, None, None],
        [None, None, None, 3, None, 3, 3],
        [None, None, 1, None, 4],
    ]
