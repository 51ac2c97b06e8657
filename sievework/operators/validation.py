"""Checks of extracted values: plausibility, agreement within a work, primary sources, thresholds.

An extraction has a work, an entity and an attribute (`KEY`), a value (value_num or value_cat), a confidence and a status.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import if_known, normalized, squish
from sievework.sources.tables import dealt, held

KEY = ["work_id", "entity_id", "attribute_id"]
TOLERANCE = 0.05
#: Kinds of document that are never a primary source.
NEVER_PRIMARY = ("poster", "conference_abstract")
#: A citation in brackets: (Name, 1999), (Name & Name 1999), (Name et al., 1999).
CITATION = r"\([A-Z][\p{L}'-]+( et al\.| & [A-Z][\p{L}'-]+)?,? *\d{4}\)"


def listed(values: Column, sep: str = ";") -> Column:
    return F.transform(F.split(values, sep), lambda x: F.trim(x))


def plausibility(extractions: DataFrame, attributes: DataFrame) -> DataFrame:
    """status and reason of raw extractions by their attribute: kind, unit, lowest, highest, accepted (separated by ;).

    A unit that differs is flagged but stays raw. The accepted list is compared exactly. attributes is counted, and goes to every task if it
    is small: extractions have few attributes, so a shuffle by them would leave all rows to a few tasks.
    """
    a = attributes.select("attribute_id", "kind", F.col("unit").alias("unit_wanted"), "lowest", "highest", "accepted")
    numeric, v = F.col("kind") == "numeric", F.col("value_num")
    known = F.coalesce(F.array_contains(listed("accepted"), F.col("value_cat")), F.col("value_cat").isNull() & F.col("accepted").isNull())
    reason = (
        F.when(numeric & v.isNull(), "number_missing")
        .when(numeric & (v < F.col("lowest")), "below_minimum")
        .when(numeric & (v > F.col("highest")), "above_maximum")
        .when(numeric & (normalized("unit") != normalized("unit_wanted")), "unit_differs")
        .when((F.col("kind") == "categorical") & ~known, "not_in_vocabulary")
    )
    out = extractions.join(held(a), "attribute_id", "left").withColumn("reason", reason)
    return out.withColumn("new_status", F.when(F.col("reason").isNull() | (F.col("reason") == "unit_differs"), "raw").otherwise("rejected"))


def diverge(kind: Column, num: Column, cat: Column, over, tolerance: float = TOLERANCE) -> Column:
    """Whether the values of a window differ: numbers by more than a share of their mean size, words but for case and outer space."""
    spread = F.max(num).over(over) - F.min(num).over(over) > tolerance * F.avg(F.abs(num)).over(over)
    return F.when(kind == "numeric", F.coalesce(spread, F.lit(False))).otherwise(F.size(F.collect_set(F.lower(F.trim(cat))).over(over)) > 1)


def reconcile(extractions: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """new_status and reason: of values that agree the most confident stays raw (ties to the smaller id), values that differ conflict.

    One window exchange on KEY serves all; a work names few values of one attribute.
    """
    group = Window.partitionBy(*KEY)
    best = group.orderBy(F.desc_nulls_last("confidence"), "extraction_id")
    out = dealt(extractions, *KEY).withColumns({
        "n_in_group": F.count(F.lit(1)).over(group),
        "diverges": diverge(F.col("kind"), F.col("value_num"), F.col("value_cat"), group, tolerance),
        "place": F.row_number().over(best),
    })
    status = F.when(F.col("n_in_group") == 1, "raw").when(F.col("diverges"), "conflict").when(F.col("place") == 1, "raw").otherwise("rejected")
    reason = F.when(F.col("new_status") == "conflict", "conflict_within_work").when(F.col("new_status") == "rejected", "duplicate_within_work")
    return out.withColumn("new_status", status).withColumn("reason", reason).drop("place")


def apply_status(extractions: DataFrame, decided: DataFrame) -> DataFrame:
    """extractions with status and reason of the decided rows; a reason may become null, so a flag marks them. decided: one row an id."""
    d = decided.select("extraction_id", F.col("new_status").alias("_status"), F.col("reason").alias("_reason"), F.lit(True).alias("_hit"))
    out = extractions.join(d, "extraction_id", "left")
    new = {"status": F.when(F.col("_hit"), F.col("_status")).otherwise(F.col("status")), "reason": F.when(F.col("_hit"), F.col("_reason")).otherwise(F.col("reason"))}
    return out.withColumns(new).drop("_status", "_reason", "_hit")


def reconciled(extractions: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """extractions after reconcile on the raw ones; rows without a reason keep the one they had."""
    decided = reconcile(extractions.where("status = 'raw'"), tolerance).where("reason IS NOT NULL")
    return apply_status(extractions, decided)


def compiled(extractions: DataFrame, compilations: DataFrame) -> DataFrame:
    """compiled: whether the work (by doi, any case) is a listed compilation and the entity none of its own (separated by ;)."""
    c = compilations.select(F.lower(squish("doi")).alias("_doi"), F.transform(F.split(F.coalesce("own_entities", F.lit("")), ";"), lambda x: squish(x)).alias("_own"))
    c = c.groupBy("_doi").agg(F.first("_own").alias("_own"))
    out = extractions.join(c, F.lower("doi") == F.col("_doi"), "left")
    own = F.array_contains("_own", F.coalesce("entity", F.lit("")))
    return out.withColumn("compiled", F.col("_doi").isNotNull() & ~F.coalesce(own, F.lit(False))).drop("_doi", "_own")


def primary_source(extractions: DataFrame) -> DataFrame:
    """origin and primary_doi. Of works with the same value the oldest that may be primary is, unless its evidence cites another.

    A work without a year has no origin; equal years go to the smaller doi. Groups take nulls as equal. Groups are summed first and joined
    back, so that a value that very many rows share (or none) is in no task's hands whole.
    """
    same = ["entity_id", "attribute_id", "value_num", "value_cat"]
    may = ~F.coalesce(F.col("document_type").isin(*NEVER_PRIMARY), F.lit(False)) & ~F.coalesce(F.col("compiled"), F.lit(False))
    out = extractions.withColumns({"cites": F.col("evidence").rlike(CITATION), "may_be_primary": may})
    first = F.min(F.when(F.col("may_be_primary") & F.col("year").isNotNull(), F.struct("year", "doi")))
    groups = out.groupBy(*[F.col(c).alias(f"_{c}") for c in same]).agg(first.alias("_of"))
    out = out.join(groups, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same]))
    oldest = F.when(~F.col("may_be_primary"), F.lit(False)).otherwise(F.when(F.col("_of").isNull(), F.lit(None)).otherwise(F.col("year") == F.col("_of.year")))
    second = F.col("cites") | ~oldest | F.coalesce("compiled", F.lit(False))
    out = out.withColumn("origin", if_known(second, F.lit("secondary"), F.lit("primary")))
    return out.withColumn("primary_doi", F.when(F.col("origin") == "secondary", F.col("_of.doi"))).drop("_of", *[f"_{c}" for c in same])


def set_document_type(works: DataFrame, work_ids: list[str], kind: str | None) -> DataFrame:
    """works with the document type of some set or cleared. An unknown type or work is an error."""
    if kind is not None and kind not in NEVER_PRIMARY:
        raise ValueError(f"unknown document type {kind!r}")
    found = {r.work_id for r in works.where(F.col("work_id").isin(work_ids)).select("work_id").distinct().collect()}  # as many as are given
    if missing := set(work_ids) - found:
        raise ValueError(f"unknown works: {', '.join(sorted(missing))}")
    return works.withColumn("document_type", F.when(F.col("work_id").isin(work_ids), F.lit(kind)).otherwise(F.col("document_type")))


def thresholds(predictions: DataFrame, gold: DataFrame, wanted: float, tolerance: float = TOLERANCE, min_reviewers: int = 1) -> DataFrame:
    """For each attribute the lowest threshold of 0.05 to 0.95 whose precision is as wanted, else the most precise, for full review.

    gold: KEY, value; only groups of one distinct value and at least min_reviewers rows count. Rejected and conflicting extractions take
    no part. The curve is one aggregation of 19 conditional counts by attribute, not a join with the grid.
    """
    rows = dealt(gold.select(*KEY, "value"), *KEY)  # first, so that no task sorts a whole split to find its least texts
    agreed = rows.groupBy(*KEY).agg(F.max("value").alias("_most"), F.count(F.lit(1)).alias("_rows"), F.min("value").alias("truth")).where(f"truth = _most AND _rows >= {min_reviewers}").drop("_most", "_rows")
    truth = F.col("truth").try_cast("double")
    near = F.abs(F.col("value_num") - truth) <= tolerance * F.abs(truth)
    hit = if_known(F.col("kind") == "numeric", near, F.lower("value_cat") == F.lower("truth"))
    paired = predictions.where("status NOT IN ('rejected', 'conflict')").join(agreed, KEY).select("attribute_id", "confidence", hit.alias("hit"))
    grid = [0.05 + i * 0.05 for i in range(19)]
    above = [F.col("confidence") >= F.lit(t) for t in grid]
    told = [F.count(F.when(a & F.col("hit").isNotNull(), 1)).alias(f"n{i}") for i, a in enumerate(above)]
    right = [F.count(F.when(a & F.col("hit"), 1)).alias(f"h{i}") for i, a in enumerate(above)]
    curve = paired.groupBy("attribute_id").agg(F.count(F.lit(1)).alias("n_gold"), *told, *right)
    rate = lambda i: F.when(F.col(f"n{i}") > 0, F.col(f"h{i}") / F.col(f"n{i}"))
    points = F.array(*[F.struct(F.lit(t).alias("threshold"), rate(i).alias("precision"), (F.col(f"h{i}") / F.col("n_gold")).alias("recall")) for i, t in enumerate(grid)])
    curve = curve.select("attribute_id", "n_gold", points.alias("points"))
    curve = curve.withColumn("ok", F.filter("points", lambda p: p["precision"] >= wanted))
    top = F.array_max(F.transform("points", lambda p: p["precision"]))
    rest = F.filter("points", lambda p: p["precision"].eqNullSafe(top))
    curve = curve.withColumn("pick", F.when(F.size("ok") > 0, F.col("ok")[0]).otherwise(rest[0]))
    return curve.select("attribute_id", "pick.threshold", "pick.precision", "pick.recall", "n_gold", F.when(F.size("ok") > 0, "automatic").otherwise("full_review").alias("decision"))


def apply_thresholds(extractions: DataFrame, limits: DataFrame) -> DataFrame:
    """Raw extractions at or above the threshold of an attribute decided automatically become approved. limits: one row an attribute."""
    few = held(limits.where("decision = 'automatic'").select("attribute_id", F.col("threshold").alias("_t")))
    out = extractions.join(few, "attribute_id", "left")
    up = (F.col("status") == "raw") & (F.col("confidence") >= F.col("_t"))
    return out.withColumn("status", F.when(up, "approved").otherwise(F.col("status"))).drop("_t")
