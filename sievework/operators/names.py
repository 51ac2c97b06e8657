"""Alternative names of entities: where they come from, which may be used, and conflicts between names and ids."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import first_two_words, name_pattern, squish, truncated

from .mentions import mentions

ENDING = "(us|a|um|is|e)$"
DECISIONS = ("global", "this_work_only", "never")


def curated_aliases(aliases: DataFrame, targets: DataFrame) -> DataFrame:
    """Aliases by accepted name, of targets only; a blank doi means that the alias holds in every work."""
    doi = F.nullif(F.lower(squish("work_doi")), F.lit(""))
    return aliases.join(targets.select("entity_id", "entity").distinct(), "entity").select("entity_id", "alias", F.coalesce("source", F.lit("curated")).alias("source"), doi.alias("work_doi"))


def stem(name: Column | str) -> Column:
    """Genus and epithet without its ending."""
    p = F.split(F.col(name) if isinstance(name, str) else name, " ")
    return F.concat_ws(" ", F.get(p, F.lit(0)), F.regexp_replace(F.coalesce(F.get(p, F.lit(1)), F.lit("")), ENDING, ""))


def matched_targets(targets: DataFrame, valid: DataFrame) -> DataFrame:
    """entity_id, entity and matched: the valid name equal to it, else the only one of the same stem, else null."""
    names = valid.select("name").distinct()
    by_stem = names.groupBy(stem("name").alias("_stem")).agg(F.count(F.lit(1)).alias("_n"), F.min("name").alias("_only")).where("_n = 1")
    out = targets.select("entity_id", "entity").distinct().join(names.withColumn("_same", F.col("name")), F.col("entity") == F.col("name"), "left").drop("name")
    return out.withColumn("_stem", stem("entity")).join(by_stem, "_stem", "left").select("entity_id", "entity", F.coalesce("_same", "_only").alias("matched"))


def derived_aliases(targets: DataFrame, synonyms: DataFrame, valid: DataFrame) -> DataFrame:
    """entity_id, entity, alias and reason: null for aliases to use, else why a person must decide. synonyms: name, synonym."""
    found = matched_targets(targets, valid)
    known = found.where("matched IS NOT NULL")
    by_name = synonyms.select("name", F.col("synonym").alias("alias")).union(valid.select("name", F.col("name").alias("alias"))).where("alias IS NOT NULL").distinct()
    # what only names decide is found on names, of which there are far fewer than rows
    spaces = F.size(F.split("alias", " ")) - 1
    counts = known.groupBy("matched", "entity").agg(F.count(F.lit(1)).alias("_k")).join(by_name, F.col("matched") == F.col("name")).where("alias <> entity").groupBy("alias").agg(F.sum("_k").alias("_n"))
    is_valid = valid.select(F.col("name").alias("two")).distinct().withColumn("_valid", F.lit(True))
    also = by_name.select("name", F.col("alias").alias("two"), F.lit(True).alias("_also"))
    aliases = by_name.withColumn("two", F.concat_ws(" ", F.slice(F.split("alias", " "), 1, 2))).join(is_valid, "two", "left").join(also, ["name", "two"], "left").join(counts, "alias")
    rows = known.join(aliases, F.col("matched") == F.col("name")).where("alias <> entity")
    # an id that stands with several entities has the names of all of them
    several = found.join(found.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_e")).where("_e > 1").select("entity_id"), "entity_id", "left_semi")
    shared = several.select("entity_id", F.col("entity").alias("two")).union(several.join(by_name, F.col("matched") == F.col("name")).select("entity_id", "alias"))
    rows = rows.join(shared.distinct().withColumn("_own", F.lit(True)), ["entity_id", "two"], "left").withColumn("_own", F.coalesce("_own", "_also", F.when(F.col("two") == F.col("entity"), True)))
    reason = (
        F.when(F.col("_valid") & (F.col("two") != F.col("entity")) & (F.col("two") != F.col("matched")), "two words are another valid name")
        .when((spaces >= 2) & F.col("_own").isNull(), "three words of another name")
        .when(F.col("_n") > 1, "alias of several entities")
    )
    none = found.where("matched IS NULL").select("entity_id", "entity", F.lit(None).cast("string").alias("alias"), F.lit("name not found").alias("reason"))
    return rows.select("entity_id", "entity", "alias", reason.alias("reason")).union(none)


def all_aliases(curated: DataFrame, derived: DataFrame, present: DataFrame) -> DataFrame:
    """New aliases of both sources, the curated one first where both have a name."""
    both = curated.select("entity_id", "alias", "source", "work_doi", F.lit(0).alias("_o")).union(derived.where("reason IS NULL").select("entity_id", "alias", F.lit("authority"), F.lit(None).cast("string"), F.lit(1)))
    first = both.withColumn("_k", F.row_number().over(Window.partitionBy("entity_id", "alias").orderBy("_o", "source", "work_doi"))).where("_k = 1").drop("_k", "_o")
    return new_aliases(first, present)


def new_aliases(aliases: DataFrame, present: DataFrame) -> DataFrame:
    return aliases.join(present, ["entity_id", "alias"], "left_anti")


def names_of(targets: DataFrame, aliases: DataFrame, works: DataFrame | None = None) -> DataFrame:
    """entity_id (and work_id) with the sorted list of its names: accepted, global aliases, and with works those of the work's doi."""
    every = targets.select("entity_id", F.col("entity").alias("name")).union(aliases.where("work_doi IS NULL").select("entity_id", "alias"))
    if works is None:
        return every.groupBy("entity_id").agg(F.array_sort(F.collect_set("name")).alias("names"))
    links = works.select("work_id", "entity_id", F.lower("doi").alias("doi"))
    scoped = links.join(aliases.where("work_doi IS NOT NULL").select("entity_id", F.lower("work_doi").alias("doi"), "alias"), ["entity_id", "doi"]).select("work_id", "entity_id", F.col("alias").alias("name"))
    return links.join(every, "entity_id").select("work_id", "entity_id", "name").union(scoped).groupBy("work_id", "entity_id").agg(F.array_sort(F.collect_set("name")).alias("names"))


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\.^$|?*+()\[\]{}])", r"\\$1")


def pattern_of(names: Column) -> Column:
    """As functions.text.name_pattern, of a column of names."""
    second = lambda x: F.element_at(F.split(x, " "), 2)
    is_epithet = lambda x: (F.size(F.split(x, " ")) >= 2) & second(x).rlike("^[a-z-]{3,}$") & ~second(x).isin("cf", "aff", "sp", "spp")
    short = F.transform(F.filter(names, is_epithet), lambda x: F.concat(escaped(F.substring(x, 1, 1)), F.lit(r"\.?\s+"), second(x)))
    return F.concat(F.lit(r"\b("), F.array_join(F.concat(F.transform(names, escaped), short), "|"), F.lit(")"))


def mentioned(texts: DataFrame, names: list[str], text: str = "text") -> DataFrame:
    """texts with mentions: whether one of the names, or its short form, stands there as a word, in any case."""
    return texts.withColumn("mentions", F.coalesce(F.col(text).rlike("(?i)" + name_pattern(names) + r"\b"), F.lit(False)))


def alias_evidence(doubtful: DataFrame, works: DataFrame, links: DataFrame) -> DataFrame:
    """For each doubtful alias (entity_id, entity, alias): works that name it, those linked to the entity, other entities with the alias, and an example.

    works (work_id, title, text) are searched once by one automaton of all aliases; only hits move, each with the words around it.
    """
    named = doubtful.where("alias IS NOT NULL")
    found = mentions(works, named.select(F.col("alias").alias("name")), ["work_id", "title", "text"]).where("whole_at IS NOT NULL").withColumnsRenamed({"name": "alias", "whole_at": "_at"})
    snippet = F.concat(truncated("title", 60), F.lit(": …"), squish(F.substr("text", F.greatest(F.lit(1), F.col("_at") - 150), F.least(F.col("_at") - 1, F.lit(150)) + F.length("alias") + 150)), F.lit("…"))
    hits = found.select("alias", "work_id", snippet.alias("example"))
    linked = named.join(hits, "alias").join(links.select("entity_id", "work_id", F.lit(1).alias("_l")).distinct(), ["entity_id", "work_id"], "left")
    seen = linked.groupBy("entity_id", "alias").agg(F.count(F.lit(1)).alias("n_works"), F.count("_l").alias("n_works_of_entity"), F.min_by("example", F.struct(F.col("_l").isNull(), "work_id")).alias("example"))
    others = named.groupBy("alias").agg(F.array_sort(F.collect_set("entity")).alias("_all"))
    out = doubtful.join(seen, ["entity_id", "alias"], "left").join(others, "alias", "left")
    rest = F.nullif(F.array_join(F.array_except("_all", F.array("entity")), "; "), F.lit(""))
    return out.select("entity_id", "entity", "alias", F.coalesce("n_works", F.lit(0)).alias("n_works"), F.coalesce("n_works_of_entity", F.lit(0)).alias("n_works_of_entity"), "example", rest.alias("other_entities"))


def decided_aliases(sheet: DataFrame, reviewer: str, date: str) -> DataFrame:
    """The aliases that a reviewed sheet admits; a decision out of the list, or a scoped one without a doi, is an error that names the aliases."""
    d = sheet.withColumns({"decision": F.nullif(squish("decision"), F.lit("")), "work_doi": F.nullif(squish("work_doi"), F.lit(""))})
    bad = d.where((F.col("decision").isNotNull() & ~F.col("decision").isin(*DECISIONS)) | ((F.col("decision") == "this_work_only") & F.col("work_doi").isNull()))
    if names := [r.alias for r in bad.select("alias").limit(20).collect()]:
        raise ValueError(f"invalid decisions: {'; '.join(map(str, names))}")
    note = F.when(F.coalesce("note", F.lit("")) == "", "").otherwise(F.concat(F.lit("; "), "note"))
    return d.where(F.col("decision").isin("global", "this_work_only") & F.col("alias").isNotNull()).select("entity", "alias", F.when(F.col("decision") == "this_work_only", F.lower("work_doi")).alias("work_doi"), F.concat(F.lit(f"{reviewer}, {date}: review of doubtful aliases"), note).alias("source"))


def name_conflicts(rows: DataFrame) -> DataFrame:
    """Of rows (sheet, entity_id, name): ids with several names and names with several ids, their line counts, sheets and kind of conflict."""
    pairs = rows.select("sheet", squish("entity_id").alias("entity_id"), first_two_words("name").alias("name")).where("entity_id IS NOT NULL AND name IS NOT NULL")
    counts = pairs.groupBy("entity_id", "name").agg(F.count(F.lit(1)).alias("n_lines"), F.array_join(F.array_sort(F.collect_set("sheet")), "|").alias("sheets"))
    counts = counts.withColumns({"_names": F.count(F.lit(1)).over(Window.partitionBy("entity_id")), "_ids": F.count(F.lit(1)).over(Window.partitionBy("name"))})
    kind = F.when((F.col("_names") > 1) & (F.col("_ids") > 1), "id and name").when(F.col("_names") > 1, "one id, several names").otherwise("one name, several ids")
    return counts.where("_names > 1 OR _ids > 1").withColumn("conflict", kind).drop("_names", "_ids")


def against_authority(cases: DataFrame, authority: DataFrame) -> DataFrame:
    """cases with the authority's name for theirs (authority: name, accepted) and whether it is the same."""
    return cases.join(authority.select("name", "accepted"), "name", "left").withColumn("is_accepted", F.col("accepted").eqNullSafe(F.col("name")) & F.col("accepted").isNotNull())


def decision_template(cases: DataFrame) -> DataFrame:
    """A row to decide for each id, with its spellings by falling line count."""
    spelling = F.concat("name", F.lit(" ("), F.col("n_lines").cast("string"), F.lit(" lines, "), "sheets", F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n_lines")).alias("n"), "name", spelling.alias("s"), "conflict")))
    out = cases.groupBy("entity_id").agg(ordered.alias("l"))
    return out.select("entity_id", F.array_join(F.transform("l", lambda x: x["s"]), " | ").alias("spellings"), F.col("l")[0]["conflict"].alias("conflict"), F.lit(None).cast("string").alias("accepted_name"))


def synchronised_aliases(cache: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    """Distinct aliases of targets from an authority's cache (name, synonym), empty ones and the accepted name left out."""
    rows = targets.select("entity_id", "entity").distinct().join(cache.withColumn("synonym", squish("synonym")), F.col("entity") == F.col("name"))
    rows = rows.where("synonym <> '' AND synonym <> entity").select("entity_id", F.col("synonym").alias("alias")).distinct()
    return rows.withColumns({"source": F.lit(source), "work_doi": F.lit(None).cast("string")})


def review_sheet(evidence: DataFrame) -> DataFrame:
    """The evidence of doubtful aliases, most linked works first, with blank columns to decide in; for people, so in one order."""
    blank = F.lit("")
    return evidence.orderBy(F.desc("n_works_of_entity"), F.desc("n_works"), "entity", "alias").withColumns({"decision": blank, "work_doi": blank, "note": blank})
