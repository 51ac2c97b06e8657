"""Gold standard and human review: samples that a seed decides, agreement, verdicts."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import if_known
from sievework.sources.tables import dealt, held

from .validation import KEY, TOLERANCE


def drawn_by(seed: int, *ids: str) -> Column:
    """A pseudo-random text by which rows are put in an order that only the seed and the ids decide."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]), 256)


def sampled(rows: DataFrame, fraction: float, seed: int, *ids: str, least: int = 0) -> DataFrame:
    """floor(n * fraction) rows, but at least `least`. The order's global limit keeps only the asked rows of each partition."""
    n = max(least, int(rows.count() * fraction + 1e-9))
    return rows.withColumn("_d", drawn_by(seed, *ids)).orderBy("_d", *ids).limit(n).drop("_d")


def stratified(rows: DataFrame, by: str, n: int, least: int, seed: int, *ids: str) -> DataFrame:
    """From each stratum max(min(least, its size), round(n * its size / all)) rows; halves are rounded to even."""
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_g"))
    total = sizes.agg(F.sum("_g").alias("_n"))
    quota = sizes.crossJoin(F.broadcast(total)).select(by, F.greatest(F.least(F.lit(least), F.col("_g")), F.bround(n * F.col("_g") / F.col("_n"))).alias("_q"))
    order = Window.partitionBy(by).orderBy(drawn_by(seed, *ids), *ids)
    return rows.join(quota, by).withColumn("_k", F.row_number().over(order)).where("_k <= _q").drop("_k", "_q")


def blank_sheet(works: DataFrame, attributes: DataFrame) -> DataFrame:
    """A row to fill in for each work, entity and attribute. attributes is a vocabulary, so a bounded list."""
    blank = F.lit("")
    return works.crossJoin(attributes.select("attribute_id")).withColumns({"value": blank, "evidence": blank})


def filled(sheet: DataFrame, reviewer: str) -> DataFrame:
    return sheet.where("value IS NOT NULL AND value <> ''").withColumn("reviewer", F.lit(reviewer))


def agreement(gold: DataFrame, kinds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """For each attribute, over groups of exactly two rows, n and the share that agrees: words but for case, numbers within the tolerance."""
    rows = dealt(gold.select(*KEY, "value"), *KEY)  # first, so that no task sorts a whole split to find its least texts
    pairs = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"), *_pair("value")).where("_n = 2").join(held(kinds.select("attribute_id", "kind")), "attribute_id", "left")
    a, b = F.col("_low").try_cast("double"), F.col("_high").try_cast("double")
    near = F.abs(a - b) <= tolerance * (F.abs(a) + F.abs(b)) / 2
    same = if_known(F.col("kind") == "categorical", F.lower("_low") == F.lower("_high"), near)
    return pairs.withColumn("same", same).groupBy("attribute_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("same").cast("int")).alias("agreement"))


def _pair(value: str) -> list[Column]:
    return [F.min(value).alias("_low"), F.max(value).alias("_high")]


def review_queue(extractions: DataFrame, limits: DataFrame, audit: float, seed: int) -> DataFrame:
    """Rows for review with their queue: raw ones below or without a threshold or under full review, conflicts, a sample of approved ones."""
    few = held(limits.select("attribute_id", F.col("threshold").alias("_t"), F.col("decision").alias("_d")))
    raw = extractions.where("status = 'raw'").join(few, "attribute_id", "left")
    below = raw.where("_t IS NULL OR confidence < _t OR _d = 'full_review'").select(*extractions.columns)
    parts = [(below, "below_threshold"), (extractions.where("status = 'conflict'"), "conflict"), (sampled(extractions.where("status = 'approved'"), audit, seed, "extraction_id"), "audit")]
    return reduce(DataFrame.unionByName, [p.withColumn("queue", F.lit(q)) for p, q in parts])


def apply_verdicts(extractions: DataFrame, reviews: DataFrame) -> DataFrame:
    """ok approves, wrong rejects, ambiguous keeps the status; of several verdicts on a row the latest counts (ties to the reviewer last in order)."""
    last = Window.partitionBy("extraction_id").orderBy(F.desc("at"), F.desc("reviewer"))
    v = reviews.where(F.col("verdict").isin("ok", "wrong", "ambiguous")).withColumn("_k", F.row_number().over(last)).where("_k = 1").select("extraction_id", F.col("verdict").alias("_v"))
    out = extractions.join(v, "extraction_id", "left")
    status = F.when(F.col("_v") == "ok", "approved").when(F.col("_v") == "wrong", "rejected").otherwise(F.col("status"))
    return out.withColumns({"status": status, "reason": F.when(F.col("_v") == "wrong", "human_review").otherwise(F.col("reason"))}).drop("_v")


def training_rows(reviews: DataFrame, extractions: DataFrame, chunks: DataFrame) -> DataFrame:
    """text, attribute_id, label and verdict of reviewed rows; the label is the corrected value, else the word, else the number."""
    label = F.coalesce(F.nullif("corrected", F.lit("")), "value_cat", F.col("value_num").cast("string"))
    rows = reviews.where(F.col("verdict").isin("ok", "wrong")).join(extractions, "extraction_id").join(chunks, "chunk_id")
    return rows.select("text", "attribute_id", label.alias("label"), "verdict")


def coverage(targets: DataFrame, pairs: DataFrame, done: tuple[str, ...] = ("extracted", "reviewed")) -> DataFrame:
    """Attributes with data and wanted, for each entity."""
    has = F.count_if(F.col("state").isin(*done))
    return targets.join(pairs, "entity_id").groupBy("entity").agg(has.alias("with_data"), F.count(F.lit(1)).alias("wanted"))


def confusion_counts(answers: DataFrame, truth: str, answer: str) -> DataFrame:
    """One row of true and false positives and negatives, rows without an answer, sensitivity and specificity."""
    t, a = F.col(truth), F.col(answer)
    n = {"tp": t & a, "fp": ~t & a, "tn": ~t & ~a, "fn": t & ~a, "unanswered": a.isNull()}
    out = answers.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in n.items()])
    rate = lambda x, y: F.when(F.col(x) + F.col(y) > 0, F.col(x) / (F.col(x) + F.col(y)))
    return out.withColumns({"sensitivity": rate("tp", "fn"), "specificity": rate("tn", "fp")})


def review_sheet(queue: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """The columns a reviewer sees, with a blank verdict and correction: with chunks (chunk_id, text) also what the value was read from."""
    seen = [c for c in ("extraction_id", "queue", "work_id", "entity_id", "attribute_id", "value_num", "value_cat", "unit", "evidence", "page", "confidence") if c in queue.columns]
    rows = queue.select(*seen, *(["chunk_id"] if chunks is not None else []))
    if chunks is not None:
        rows = rows.join(chunks.select("chunk_id", "text"), "chunk_id", "left").select(*seen, "text")
    return rows.withColumns({"verdict": F.lit(""), "corrected": F.lit("")})


def metrics(limits: DataFrame, agreed: DataFrame, covered: DataFrame) -> DataFrame:
    """One row of what a release reports: attributes decided automatically and in full review, mean agreement, share of pairs with data."""
    a = limits.agg(F.count_if(F.col("decision") == "automatic").alias("automatic"), F.count_if(F.col("decision") == "full_review").alias("full_review"))
    b = agreed.agg(F.avg("agreement").alias("agreement"), F.sum("n").alias("n_gold_pairs"))
    c = covered.agg(F.sum("with_data").alias("with_data"), F.sum("wanted").alias("wanted"))
    one = F.broadcast  # each side is one row
    return a.crossJoin(one(b)).crossJoin(one(c)).withColumn("coverage", F.col("with_data") / F.col("wanted"))


def attribute_metrics(limits: DataFrame, agreed: DataFrame) -> DataFrame:
    """A row for each attribute that has a threshold or gold pairs: all its figures, null where there are none."""
    return limits.join(agreed, "attribute_id", "full")


def coverage_summary(covered: DataFrame) -> DataFrame:
    """One row: least, quartiles, mean and most of the attributes with data of an entity, over all entities; exact quantiles."""
    at = lambda p: F.percentile("with_data", F.lit(p))
    return covered.agg(F.min("with_data").alias("least"), at(0.25).alias("first_quartile"), at(0.5).alias("median"), F.avg("with_data").alias("mean"), at(0.75).alias("third_quartile"), F.max("with_data").alias("most"))
