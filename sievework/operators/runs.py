"""Running a model over pending pairs under a spending limit, and checks before a run."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources.tables import scratch, settled, until_exit

from .extraction import open_vocabularies
from .gold import drawn_by


@dataclass
class Outcome:
    """What a run did: its extractions as a path, pairs asked, money spent, and whether the limit stopped it."""

    path: str
    pairs: int
    usd: float
    stopped: bool


def run_pairs(pending: DataFrame, ask: Callable[[DataFrame], DataFrame], spent: Callable[[], float], limit: float, path: str, at_once: int = 500, seed: int = 1) -> Outcome:
    """ask(pairs) -> extractions, over `at_once` pairs at a time in an order by seed; after each part the money spent is held against the
    limit. The pairs are found once and written by part, with their numbers; each part is then read alone. Its extractions are written
    under its own number, so a run that is taken up again writes it over; a part is bounded, and so is what the driver sees of it.
    """
    keys = ["work_id", "entity_id", "attribute_id"]
    spark = pending.sparkSession
    found = settled(pending, "pending")
    parts = max(1, -(-found.count() // at_once))
    dealt = found.withColumn("part_", F.pmod(F.xxhash64(drawn_by(seed, *keys)), F.lit(parts)).cast("int"))
    folder = scratch(spark, "dealt")
    dealt.repartition("part_").write.partitionBy("part_").parquet(folder)
    until_exit(spark, folder)
    sizes = {r.part_: r["count"] for r in dealt.groupBy("part_").count().collect()}  # one row for each part
    done = 0
    for part in sorted(sizes):
        mine = spark.read.schema(pending.schema).parquet(f"{folder}/part_={part}")
        ask(mine).write.mode("overwrite").parquet(f"{path}/part={part}")
        done += sizes[part]
        if spent() > limit:
            return Outcome(path, done, spent(), True)
    return Outcome(path, done, spent(), False)


def cost_rows(spark: SparkSession, outcome: Outcome, used: DataFrame | None = None) -> DataFrame:
    """A row for each model used, or one of zeros, so that every run leaves a trace."""
    schema = "model string, input double, output double, usd double"
    rows = used.select("model", F.col("input").cast("double"), F.col("output").cast("double"), "usd") if used is not None and used.limit(1).count() else spark.createDataFrame([(None, 0.0, 0.0, 0.0)], schema)
    return rows.withColumns({"pairs": F.lit(outcome.pairs), "stopped": F.lit(outcome.stopped)})


def valid_year(year, now: int) -> int:
    """A year of publication from 1700 to now, as an integer; anything else is an error."""
    if isinstance(year, bool) or year is None or int(year) != float(year) or not 1700 <= int(year) <= now:
        raise ValueError(f"no year of publication: {year!r}")
    return int(year)


def preflight(attributes: DataFrame, targets: DataFrame, settings, services: dict[str, Callable[[], bool]]) -> list[tuple[str, bool, str]]:
    """(check, passed, what was found) of what a run needs: targets, attributes with terms and closed vocabularies, settings, services."""
    n = targets.limit(1).count()
    out = [("targets", n > 0, "there are targets" if n else "no targets")]
    terms = attributes.where(F.trim(F.coalesce("search_terms", F.lit(""))) == "").count()
    out.append(("search terms", terms == 0, f"{terms} attributes without terms"))
    open_ = open_vocabularies(attributes).count()
    out.append(("vocabularies", open_ == 0, f"{open_} vocabularies are not closed"))
    out.append(("precision", 0 < settings.wanted_precision <= 1, f"wanted precision {settings.wanted_precision}"))
    out.append(("languages", bool(settings.languages), f"{len(settings.languages)} languages"))
    for name, answers in services.items():
        try:
            out.append((name, bool(answers()), "asked"))
        except OSError as e:
            out.append((name, False, str(e)))
    return out
