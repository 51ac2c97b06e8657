"""Extraction through batches of prompts, in two stages, that a broken run takes up again.

A batch holds the prompts of one attribute. Its answers are kept in a folder of its own, which takes its name only when they are whole;
beside them stands what was asked, so that a run that starts again with the same prompts reads the answers instead of asking (and paying)
once more, and one with other prompts is refused. Answers are checked before they count: as many as prompts, each of them readable. What a
run found is written once both stages have all their answers, or not at all.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources.tables import exists, renamed, settled

from .extraction import checked_batch, recorded
from .model import batch_within

JOB = ["work_id", "entity_id", "attribute_id", "chunk_id"]
#: Said once more to the stronger model.
REINFORCED = "The passage was read before and a value without its sentence was given. Quote the sentence word for word, or say that there is none."

Ask = Callable[[str, DataFrame], DataFrame]


def fingerprint(jobs: DataFrame) -> str:
    """What tells two lists of jobs apart, whatever their order: their number and a sum of hashes."""
    r = jobs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*JOB, "prompt").cast("decimal(38,0)")).alias("sum")).first()
    return f"{r.n}-{r['sum'] or 0}"


def answered(spark: SparkSession, jobs: DataFrame, ask: Ask, folder: str, label: str) -> DataFrame | None:
    """The jobs (JOB, prompt) with the columns that ask(attribute, its jobs) adds, batch by batch, taken from the folder where it has them.

    The batches are as many as the jobs have attributes, a vocabulary. None without jobs.
    """
    kept = []
    for attribute in sorted(r.attribute_id for r in jobs.select("attribute_id").distinct().collect()):
        mine = jobs.where(F.col("attribute_id") == attribute)
        name = f"{folder}/{label}-{folder_name(attribute)}"
        asked = fingerprint(mine)
        if exists(spark, name):
            before = spark.read.parquet(f"{name}/asked").first().asked
            if before != asked:
                raise ValueError(f"{name} holds the answers to other prompts; take another folder")
        else:
            part = f"{name}.part"
            answers = ask(attribute, mine)
            answers.write.mode("overwrite").parquet(f"{part}/answers")
            written = spark.read.schema(answers.schema).parquet(f"{part}/answers")
            checked_batch(written, mine.count(), f"{label} / {attribute}")
            spark.createDataFrame([(asked,)], "asked string").write.mode("overwrite").parquet(f"{part}/asked")
            renamed(spark, part, name)
        kept.append(spark.read.parquet(f"{name}/answers"))
    if not kept:
        return None
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def folder_name(text: str) -> str:
    """A name for a folder that two different texts do not share."""
    import re
    import zlib

    return f"{re.sub(r'[^A-Za-z0-9_-]', '_', text)[:60]}-{zlib.crc32(text.encode()):08x}"


def extract_in_batches(jobs: DataFrame, ask: Ask, ask_strong: Ask, prices: DataFrame, limit: float, folder: str, chunks: DataFrame, contexts: DataFrame, system_length: int = 0) -> dict[str, DataFrame]:
    """calls and extractions of jobs (JOB, kind, model, prompt), and the estimated price as `estimate`.

    ask adds to its jobs the columns of model.VALUE and is the cheap model; answers without a sentence go to ask_strong with a reinforced
    prompt. A batch whose estimated price is over the limit, or unknown, is refused before anything is sent. The results are written to
    folder/calls and folder/extractions under other names first; a folder that has them is read.
    """
    spark = jobs.sparkSession
    done = {n: f"{folder}/{n}" for n in ("calls", "extractions")}
    if all(exists(spark, p) for p in done.values()):
        return {n: spark.read.parquet(p) for n, p in done.items()}
    jobs = settled(jobs, "jobs")
    estimate = batch_within(jobs, system_length, prices, limit)
    plain = jobs.select(*JOB, "kind", "prompt")
    first = answered(spark, plain, ask, folder, "value")
    if first is None:
        return {}
    again = settled(first.where("evidence IS NULL").select(*JOB, "kind", F.concat("prompt", F.lit(f"\n\n{REINFORCED}")).alias("prompt")), "again")
    second = answered(spark, again, ask_strong, folder, "strong")
    final = first.where("evidence IS NOT NULL").withColumn("escalated", F.lit(False))
    if second is not None:
        final = final.unionByName(second.withColumn("escalated", F.lit(True)))
    final = settled(final, "final")
    calls = final.select(*JOB, "escalated", F.coalesce("found", F.lit(False)).alias("found"))
    found = final.where("found")
    parts = [recorded(found.where(F.col("escalated") == strong).drop("escalated", "found", "prompt"), chunks, contexts, origin) for strong, origin in ((False, "llm"), (True, "llm_escalated"))]
    results = {"calls": calls, "extractions": parts[0].unionByName(parts[1])}
    for n, df in results.items():
        df.write.mode("overwrite").parquet(f"{done[n]}.part")
    for n in results:
        if not exists(spark, done[n]):
            renamed(spark, f"{done[n]}.part", done[n])
    return {n: spark.read.parquet(p) for n, p in done.items()} | {"estimate": spark.createDataFrame([(estimate,)], "usd double")}
