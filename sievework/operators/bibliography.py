"""Matching of references with candidate records by title, year and author."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import title_key
from sievework.sources.tables import dealt

ACCEPT, REVIEW, CONTAINED, LEAST_CONTAINED = 0.90, 0.75, 0.89, 40


def title_similarity(a: Column | str, b: Column | str) -> Column:
    """1 less the edit distance by the longer key's length; at least CONTAINED if the shorter key is long and stands in the longer. 0 for nulls."""
    return _key_similarity(title_key(a), title_key(b))


def title_similarities(references: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates (ref_id, cand_title and others) with the similarity of their title to that of their reference (ref_id, title). The key of a
    reference is taken once, and a title that several candidates of a reference have is compared once: its first row hands it on."""
    pairs = candidates.join(references.select("ref_id", title_key("title").alias("_a")), "ref_id")
    title = Window.partitionBy("ref_id", "cand_title").orderBy("cand_title")
    first = pairs.withColumn("_b", F.when(F.row_number().over(title) == 1, title_key("cand_title")))
    similarity = F.first(_key_similarity(F.col("_a"), F.col("_b"))).over(title.rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("similarity", similarity).drop("_a", "_b")


def _held(a: Column, b: Column) -> Column:
    """What two known keys are like without counting edits: 1 if equal, CONTAINED if the shorter is long and stands in the longer, else 0."""
    short_in_long = F.when(F.length(a) <= F.length(b), F.contains(b, a)).otherwise(F.contains(a, b))
    return F.when(a == b, F.lit(1.0)).when((F.least(F.length(a), F.length(b)) >= LEAST_CONTAINED) & short_in_long, F.lit(CONTAINED)).otherwise(F.lit(0.0))


def _key_similarity(a: Column, b: Column) -> Column:
    by_edits = F.when(a == b, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))
    known = a.isNotNull() & b.isNotNull() & (a != "") & (b != "")
    return F.when(known, F.greatest(by_edits, _held(a, b))).otherwise(F.lit(0.0))


def author_agrees(authors: Column | str, surname: Column | str) -> Column:
    """Whether the longest part of the surname is a word of the authors (the first of equal length); null if either is not known."""
    parts = F.split(title_key(surname), " ")
    longest = F.aggregate(parts, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    known = F.col(authors).isNotNull() if isinstance(authors, str) else authors.isNotNull()
    given = (F.col(surname) if isinstance(surname, str) else surname) != ""
    return F.when(known & given, F.array_contains(F.split(title_key(authors), " "), longest))


def match_verdict(similarity: Column, year_gap: Column, author_ok: Column) -> Column:
    close = similarity >= ACCEPT
    return (
        F.when(similarity.isNull(), "none")
        .when(close & (year_gap == 0) & author_ok.eqNullSafe(True), "accepted")
        .when(close & (year_gap.isNull() | (year_gap <= 1)) & ~author_ok.eqNullSafe(False), "review")
        .when(similarity >= REVIEW, "review")
        .otherwise("none")
    )


def _grams(key: Column) -> Column:
    """The distinct pairs of neighbouring characters."""
    at = F.when(F.length(key) > 1, F.sequence(F.lit(1), F.length(key) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substr(key, i, F.lit(2))))


def best_candidates(references: DataFrame, candidates: DataFrame, twins: float | None = None) -> DataFrame:
    """For each reference (ref_id, title, year, authors) the best of its own candidates (ref_id, cand_id, cand_title, cand_year, surname).

    Candidates come with the reference they were looked up for, so the join is on ref_id and no edit distance is taken across references.
    Of candidates of one title only the nearest in time can be best, so a title is compared once for a reference, and keys are taken once
    for each. One likely candidate of a reference gives a similarity that others must reach: by their lengths and pairs of characters, of
    which an edit changes two at most, before edits are counted, and then up to that number of edits. With `twins`, a null doi is filled from
    a candidate of the same reference with that similarity at least, the same year and a doi; edits are counted as far as that allows.
    """
    refs = references.select("ref_id", title_key("title").alias("_a"), F.col("year").alias("_y"))
    near = F.struct(F.abs(F.col("year") - F.col("cand_year")).isNull(), F.abs(F.col("year") - F.col("cand_year")), "cand_id")
    of_title = [F.min_by(F.struct(*[c for c in candidates.columns if c not in ("ref_id", "cand_title")]), near).alias("_c")]
    if twins is not None:
        twin = F.col("cand_doi").isNotNull() & (F.col("cand_year") == F.col("year"))
        of_title.append(F.min(F.when(twin, F.struct("cand_id", "cand_doi"))).alias("_twin"))
    nearest = dealt(candidates.join(references.select("ref_id", "year"), "ref_id"), "ref_id").groupBy("ref_id", "cand_title").agg(*of_title)
    pairs = nearest.withColumn("_b", title_key("cand_title")).join(refs, "ref_id")
    known = F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_a") != "") & (F.col("_b") != "")
    longer = F.greatest(F.length("_a"), F.length("_b"))
    apart = F.abs(F.length("_a") - F.length("_b"))
    pairs = pairs.withColumn("_held", F.when(known, _held(F.col("_a"), F.col("_b"))).otherwise(F.lit(0.0)))
    pairs = pairs.withColumn("_likely", F.row_number().over(Window.partitionBy("ref_id").orderBy(F.desc("_held"), F.desc(known), apart / longer, "cand_title")) == 1)
    full = F.when(known & F.col("_likely") & (F.col("_held") < 1), 1 - F.levenshtein("_a", "_b") / longer)
    pairs = pairs.withColumn("_known", F.greatest("_held", full)).withColumn("_least", F.max("_known").over(Window.partitionBy("ref_id")))
    most = F.floor((1 - F.col("_least")) * longer + 1e-9).cast("int")  # edits that still reach it
    missing = lambda x, y: F.size(F.array_except(_grams(F.col(x)), _grams(F.col(y))))
    able = (apart <= most) & ((most > longer / 3) | (F.greatest(missing("_a", "_b"), missing("_b", "_a")) <= 2 * most))
    edits = F.when(known & ~F.col("_likely") & (F.col("_held") < 1) & able, edits_up_to("_a", "_b", most))
    similarity = F.greatest("_known", F.when(edits >= 0, 1 - edits / longer))
    scored = pairs.withColumn("similarity", similarity)
    first = F.min_by(F.struct("cand_title", "_c", "similarity"), F.struct(-F.col("similarity"), F.abs(F.col("_y") - F.col("_c.cand_year")).isNull(), F.abs(F.col("_y") - F.col("_c.cand_year")), "_c.cand_id"))
    of_reference = [first.alias("_f")]
    if twins is not None:
        allowed = F.floor((1 - twins) * longer + 1e-9).cast("int")
        edits = F.when(F.col("_twin").isNotNull() & known & (apart <= allowed), F.when(F.col("_a") == F.col("_b"), F.lit(0)).otherwise(edits_up_to("_a", "_b", allowed)))
        scored = scored.withColumn("_s", F.when(edits >= 0, 1 - edits / longer))
        like = F.col("_s") >= twins
        of_reference.append(F.min_by(F.when(like, F.col("_twin.cand_doi")), F.when(like, F.struct(-F.col("_s"), "_twin.cand_id"))).alias("_doi"))
    best = scored.groupBy("ref_id").agg(*of_reference)
    best = best.select("ref_id", "_f.cand_title", "_f._c.*", "_f.similarity", *([] if twins is None else ["_doi"]))
    if twins is not None:
        best = best.withColumn("cand_doi", F.coalesce("cand_doi", "_doi"))
    best = references.join(best, "ref_id").select(*references.columns, *[c for c in candidates.columns if c != "ref_id"], "similarity")
    best = best.withColumns({"year_gap": F.abs(F.col("year") - F.col("cand_year")), "author_ok": author_agrees("authors", "surname")})
    return best.withColumn("verdict", match_verdict(F.col("similarity"), F.col("year_gap"), F.col("author_ok")))


def edits_up_to(a: str, b: str, most: Column) -> Column:
    """The edit distance, or -1 if it is more than `most`, found without counting further."""
    return F.call_function("levenshtein", F.col(a), F.col(b), most)


def distinct_references(references: DataFrame) -> DataFrame:
    """One row for each title key and year: the first known values by ref_id, and the number of entities."""
    rows = references.where("title IS NOT NULL").withColumn("key", F.concat_ws(" ", title_key("title"), F.coalesce(F.col("year").cast("string"), F.lit("NA"))))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ref_id"))).alias(c)
    rows = rows.withColumn("doi", F.nullif(F.lower("doi"), F.lit("")))
    return rows.groupBy("key").agg(F.min_by("title", "ref_id").alias("title"), F.min("year").alias("year"), first("doi"), F.countDistinct("entity_id").alias("n_entities"))


def volume_verdict(journal_similarity: Column, year: Column, item_year: Column) -> Column:
    """probable_volume for a like journal whose first four characters of the date are within a year."""
    gap = F.abs(year - F.substring(item_year, 1, 4).try_cast("int"))
    return F.when((journal_similarity >= 0.6) & (gap <= 1), "probable_volume").otherwise("none")


def consolidated(first: str, first_doi: str, second: str, second_doi: str, third: str, failed: str) -> Column:
    """The verdict over three sources. A doi that the second accepts against another that the first wants reviewed is a conflict; a failed
    source only outweighs that nothing was found."""
    v = {c: F.col(c) for c in (first, second, third)}
    conflict = F.coalesce((v[second] == "accepted") & (v[first] == "review") & (F.col(first_doi) != F.col(second_doi)), F.lit(False))
    return (
        F.when(v[first] == "accepted", "accepted:first")
        .when((v[second] == "accepted") & ~conflict, "accepted:second")
        .when(v[third] == "accepted", "accepted:third")
        .when(conflict | v[first].eqNullSafe("review") | v[second].eqNullSafe("review") | v[third].eqNullSafe("review"), "review")
        .when(v[third] == "probable_volume", "probable_volume")
        .when(F.col(failed), "error")
        .otherwise("none")
    )


def enriched(references: DataFrame, candidates: DataFrame, least: float = 0.95) -> DataFrame:
    """Best candidates whose null doi is filled from a twin: a candidate of the same reference with a like title, the same year and a doi.

    Twins are looked for among the titles that are compared for the best, so candidates are joined and titles' keys are taken once.
    """
    return best_candidates(references, candidates, least)
