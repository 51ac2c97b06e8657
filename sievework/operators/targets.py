"""The target list: its entities and references, the works behind them, and the state of each pair of entity and attribute."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import content_id, title_key

CHARACTERS = ("external", "oral", "cartilage")
KINDS = ("categorical", "numeric")
NOT_SEARCHED, SEARCHED, EXTRACTED, REVIEWED = "not_searched", "searched_without_data", "extracted", "reviewed"


def target_list(species: DataFrame, only_described: bool = False) -> DataFrame:
    """Entities of nested rows (id, name, and for each character a struct of status and refs); described if any status says so."""
    status = {c: F.col(f"{c}.status") for c in CHARACTERS}
    described = reduce(lambda a, b: a | b, [F.coalesce(s == "described", F.lit(False)) for s in status.values()])
    out = species.select(F.col("id").alias("entity_id"), F.col("name").alias("entity"), *[s.alias(f"status_{c}") for c, s in status.items()], described.alias("described"))
    return out.where("described") if only_described else out


def references_of(species: DataFrame) -> DataFrame:
    """A row for each reference of each character; years that are no integers are null."""

    def one(c: str) -> DataFrame:
        r = species.select(F.col("id").alias("entity_id"), F.explode(f"{c}.refs").alias("r"))
        return r.select("entity_id", F.lit(c).alias("character"), F.col("r.author").alias("author"), F.col("r.year").try_cast("int").alias("year"), F.col("r.title").alias("title"), F.col("r.doi").alias("doi"), F.col("r.url").alias("url"))

    return reduce(DataFrame.unionByName, map(one, CHARACTERS))


def _first(c: str, over) -> Column:
    return F.first(c, ignorenulls=True).over(over)


def grouped_works(references: DataFrame, order: str) -> DataFrame:
    """references (doi, title, year, url) with work_id. Rows of one title key and year share the first doi and url; rows of one work its url.

    `order` says which row is first. One hop only: works that share no key stay apart.
    """
    rows = references.where("doi IS NOT NULL OR title IS NOT NULL").withColumn("doi", F.lower(F.nullif("doi", F.lit(""))))
    key = F.when(F.col("title").isNull(), F.concat(F.lit("doi:"), F.coalesce("doi", F.lit("NA")))).otherwise(F.concat_ws(" ", title_key("title"), F.coalesce(F.col("year").cast("string"), F.lit("NA"))))
    rows = rows.withColumn("_k", key)
    every = Window.unboundedPreceding, Window.unboundedFollowing
    same = Window.partitionBy("_k").orderBy(order).rowsBetween(*every)
    rows = rows.withColumns({"doi": _first("doi", same), "url": _first("url", same), "_title": F.first(F.lower("title")).over(same)})
    rows = rows.withColumn("work_id", content_id(F.coalesce("doi", "_title"))).drop("_k", "_title")
    return rows.withColumn("url", _first("url", Window.partitionBy("work_id").orderBy(order).rowsBetween(*every)))


def first_rows(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by an explicit order."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def seeded(references: DataFrame, order: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, works, triage): links are taken before works are made distinct, so that no entity is lost; seeds count as relevant."""
    rows = grouped_works(references, order)
    links = rows.select("work_id", "entity_id").distinct()
    works = first_rows(rows, ["work_id"], [order]).select("work_id", "doi", "title", "year", "url", F.lit("found").alias("status"))
    return links, works, works.select("work_id", F.lit(True).alias("relevant"), F.lit(1.0).alias("prob"), F.lit("seed").alias("decided_by"))


def checked_attributes(attributes: DataFrame) -> DataFrame:
    """attributes if it has the needed columns and kinds, else an error."""
    needed = {"attribute_id", "name", "kind", "unit", "search_terms"}
    if missing := needed - set(attributes.columns):
        raise ValueError(f"attributes lack {', '.join(sorted(missing))}")
    if attributes.where(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))).limit(1).count():
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    return attributes


def new_pairs(targets: DataFrame, attributes: DataFrame, present: DataFrame) -> DataFrame:
    """All pairs of entity and attribute that are not present, as not searched. attributes is a vocabulary, so a bounded list."""
    pairs = targets.select("entity_id").distinct().crossJoin(attributes.select("attribute_id").distinct())
    return pairs.join(present, ["entity_id", "attribute_id"], "left_anti").withColumn("state", F.lit(NOT_SEARCHED))


def set_states(pairs: DataFrame, changes: DataFrame) -> DataFrame:
    """pairs with the states of changes (entity_id, attribute_id, state), new pairs added."""
    keys = ["entity_id", "attribute_id"]
    return pairs.join(changes, keys, "left_anti").unionByName(changes.select(*pairs.columns))


def close_round(pairs: DataFrame, search_log: DataFrame) -> DataFrame:
    """Pairs not searched of entities in the search log have been searched without data."""
    seen = search_log.select("entity_id").distinct().withColumn("_seen", F.lit(True))
    out = pairs.join(seen, "entity_id", "left")
    closed = F.col("_seen").eqNullSafe(True) & (F.col("state") == NOT_SEARCHED)
    return out.withColumn("state", F.when(closed, SEARCHED).otherwise(F.col("state"))).drop("_seen")


def priorities(pairs: DataFrame, n: int) -> DataFrame:
    """The n entities with open pairs that have the fewest covered, then the most open (ties to the smaller id)."""
    out = pairs.groupBy("entity_id").agg(F.count_if(F.col("state").isin(EXTRACTED, REVIEWED)).alias("covered"), F.count_if(F.col("state") == NOT_SEARCHED).alias("open"))
    return out.where("open > 0").orderBy("covered", F.desc("open"), "entity_id").limit(n)
