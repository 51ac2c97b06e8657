import pytest
from pyspark.sql import functions as F

from sievework.operators import batches, runs
from sievework.streaming.ingest import ingest, known_keys

JOBS = [("w1", "e", "snout", "c1", "categorical", "m", "p1"), ("w1", "e", "snout", "c2", "categorical", "m", "p2"), ("w1", "e", "eyes", "c1", "numeric", "m", "p3"), ("w2", "e", "eyes", "c3", "numeric", "m", "p4")]


def given(spark, rows=JOBS):
    jobs = spark.createDataFrame(rows, "work_id string, entity_id string, attribute_id string, chunk_id string, kind string, model string, prompt string")
    chunks = spark.createDataFrame([("c1", "The snout is round. Eyes 2 mm."), ("c2", "Nothing here."), ("c3", "Eyes 3 mm.")], "chunk_id string, text string")
    contexts = spark.createDataFrame([("w1", "25"), ("w2", None)], "work_id string, stage string")
    return jobs, chunks, contexts, spark.createDataFrame([("m", 2.0, 10.0)], "model string, input double, output double")


class Model:
    """Answers by prompt; counts what it is asked, and may break down on one attribute."""

    def __init__(self, answers, broken=None):
        self.answers, self.broken, self.asked = answers, broken, []

    def __call__(self, attribute, jobs):
        self.asked.append(attribute)
        if attribute == self.broken:
            raise OSError("the line is dead")
        a = self.answers
        pick = lambda i, kind: F.coalesce(*[F.when(F.startswith(F.col("prompt"), F.lit(p)), F.lit(v[i]).cast(kind)) for p, v in a.items()])
        return jobs.withColumns({"found": pick(0, "boolean"), "value_num": pick(1, "double"), "value_cat": pick(2, "string"), "evidence": pick(3, "string"), "confidence": F.lit(0.9)})


CHEAP = {"p1": (True, None, "round", "The snout is round."), "p2": (False, None, None, None), "p3": (True, 2.0, None, None), "p4": (True, 3.0, None, "Eyes 3 mm.")}
STRONG = {"p2": (False, None, None, None), "p3": (True, 2.0, None, "Eyes 2 mm.")}


def test_a_broken_run_is_taken_up_again(spark, tmp_path):
    jobs, chunks, contexts, prices = given(spark)
    folder = f"{tmp_path}/run"
    cheap, strong = Model(CHEAP), Model(STRONG, broken="snout")
    with pytest.raises(OSError, match="dead"):
        batches.extract_in_batches(jobs, cheap, strong, prices, 1.0, folder, chunks, contexts)
    assert cheap.asked == ["eyes", "snout"] and strong.asked == ["eyes", "snout"]
    assert not (tmp_path / "run" / "extractions").exists() and not (tmp_path / "run" / "calls").exists()
    cheap, strong = Model(CHEAP), Model(STRONG)
    out = batches.extract_in_batches(jobs.repartition(3), cheap, strong, prices, 1.0, folder, chunks, contexts)
    assert cheap.asked == [] and strong.asked == ["snout"]  # only what is still open
    calls = {(r.chunk_id, r.attribute_id): (r.escalated, r.found) for r in out["calls"].collect()}
    assert calls == {("c1", "snout"): (False, True), ("c2", "snout"): (True, False), ("c1", "eyes"): (True, True), ("c3", "eyes"): (False, True)}
    found = {(r.chunk_id, r.attribute_id): (r.status, r.value_num, r.value_cat) for r in out["extractions"].collect()}
    assert found == {("c1", "snout"): ("raw", None, "round"), ("c1", "eyes"): ("raw", 2.0, None), ("c3", "eyes"): ("raw", 3.0, None)}
    cheap = Model(CHEAP)
    again = batches.extract_in_batches(jobs, cheap, cheap, prices, 1.0, folder, chunks, contexts)
    assert cheap.asked == [] and again["extractions"].count() == 3


def test_batches_are_refused_whole(spark, tmp_path):
    jobs, chunks, contexts, prices = given(spark)
    cheap = Model(CHEAP)
    with pytest.raises(ValueError, match="limit"):
        batches.extract_in_batches(jobs, cheap, cheap, prices, 1e-9, f"{tmp_path}/a", chunks, contexts)
    with pytest.raises(ValueError, match="price"):
        batches.extract_in_batches(jobs, cheap, cheap, prices.where("false"), 1.0, f"{tmp_path}/a", chunks, contexts)
    assert cheap.asked == []
    with pytest.raises(ValueError, match="answers for"):
        batches.answered(spark, jobs.select(*batches.JOB, "kind", "prompt"), lambda a, j: Model(CHEAP)(a, j).limit(1), f"{tmp_path}/b", "value")
    with pytest.raises(ValueError, match="without an answer"):
        batches.answered(spark, jobs.select(*batches.JOB, "kind", "prompt"), Model({"p1": (None, None, None, None)} | {p: (None, None, None, None) for p in ("p2", "p3", "p4")}), f"{tmp_path}/c", "value")
    plain = jobs.select(*batches.JOB, "kind", "prompt")
    batches.answered(spark, plain, cheap, f"{tmp_path}/d", "value")
    with pytest.raises(ValueError, match="other prompts"):
        batches.answered(spark, plain.withColumn("prompt", F.concat("prompt", F.lit("!"))), cheap, f"{tmp_path}/d", "value")
    assert batches.extract_in_batches(jobs.where("false"), cheap, cheap, prices, 1.0, f"{tmp_path}/e", chunks, contexts) == {}


def test_pending_pairs_are_found_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    pending = spark.range(90).selectExpr("id AS work_id", "'e' AS entity_id", "'a' AS attribute_id").mapInArrow(counted, "work_id long, entity_id string, attribute_id string")
    out = runs.run_pairs(pending, lambda p: p, lambda: 0.0, 1.0, f"{tmp_path}/r", at_once=20)
    assert seen.value == 90 and out.pairs == 90 and not out.stopped
    assert sorted(r.work_id for r in spark.read.parquet(out.path).collect()) == list(range(90))


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    run = lambda: ingest(spark, source, "k long, v long", target, state, ["k"], buckets=8).awaitTermination()
    spark.range(100).selectExpr("id AS k", "id AS v").coalesce(1).write.parquet(source)
    run()
    spark.range(98, 103).selectExpr("id AS k", "id + 1000 AS v").coalesce(1).write.mode("append").parquet(source)
    run()
    got = {r.k: r.v for r in spark.read.parquet(target).collect()}
    assert got == {k: k if k < 100 else k + 1000 for k in range(103)} and spark.read.parquet(target).count() == 103
    keys = spark.range(0).selectExpr("id AS k").schema
    some = known_keys(spark, f"{state}/keys", keys, [3], 99)
    assert 0 < some.count() < 60 and len(some.inputFiles()) > 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert {r.b for r in some.selectExpr("pmod(xxhash64(k), 8) AS b").distinct().collect()} == {3}
