"""Comparison of rounds with a reference, check sheets and their scores, and the vocabulary that values show."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import normalized, page_key, squish
from sievework.sources.tables import dealt, settled

from .gold import stratified
from .validation import KEY

VERDICTS = ("model", "sheet", "both", "neither")
NOT_TOLD, OTHER = "not told", "other (see note)"
WHERE, RIGHT_SENTENCE = ("text", "table", "figure", "not in the article"), ("yes", "no", "no sentence")
SEVERAL = " || "


def canonical_event(c: Column | str) -> Column:
    return F.regexp_replace(c, ":(temporary|permanent)$", "")


def reference_values(measurements: DataFrame, taxa: DataFrame, sources: DataFrame, attributes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(values with their source, events without one): measurements of some attributes joined to sources (event_id, citation)."""
    rows = measurements.where(F.col("attribute_id").isin(attributes)).withColumn("event_id", canonical_event("event_id")).join(taxa, "entity_id", "left")
    return rows.join(sources, "event_id"), rows.join(sources, "event_id", "left_anti").select("event_id").distinct()


def value_set(c: str) -> Column:
    """An aggregate: the distinct values, lower case and squished, without empty ones, sorted."""
    return F.array_sort(F.collect_set(F.nullif(normalized(c), F.lit(""))))


def pair_case(sheet: Column, model: Column) -> Column:
    p, m = F.size(sheet), F.size(model)
    return F.when((p == 0) & (m == 0), F.lit(None)).when(m == 0, "only_sheet").when(p == 0, "only_model").when(sheet == model, "equal").otherwise("differs")


def compared_pairs(reference: DataFrame, model: DataFrame) -> DataFrame:
    """KEY, the values of both sides, the model's evidence, and the case; pairs empty on both sides are left out.

    reference: KEY, value; model: KEY, value, evidence. Each side is aggregated before the full join.
    """
    joined = lambda c, sep: F.array_join(F.array_sort(F.collect_set(c)), sep)
    p = reference.groupBy(*KEY).agg(value_set("value").alias("_p"), joined("value", " | ").alias("sheet_value"))
    m = model.groupBy(*KEY).agg(value_set("value").alias("_m"), joined("value", " | ").alias("model_value"), joined("evidence", SEVERAL).alias("evidence"))
    none = F.array().cast("array<string>")
    both = p.join(m, KEY, "full").withColumn("case", pair_case(F.coalesce("_p", none), F.coalesce("_m", none)))
    return both.where("case IS NOT NULL").drop("_p", "_m")


def stability(first: DataFrame, second: DataFrame, pairs: DataFrame) -> DataFrame:
    """KEY of pairs and stable: whether two rounds gave the same set, empty sets too."""
    sets = [r.groupBy(*KEY).agg(value_set("value").alias(f"_{i}")) for i, r in enumerate((first, second))]
    none = F.array().cast("array<string>")
    out = pairs.select(*KEY).distinct().join(sets[0], KEY, "left").join(sets[1], KEY, "left")
    return out.select(*KEY, (F.coalesce("_0", none) == F.coalesce("_1", none)).alias("stable"))


def case_counts(pairs: DataFrame) -> DataFrame:
    n = {c: F.count_if(F.col("case") == c) for c in ("equal", "differs", "only_sheet", "only_model")}
    return pairs.groupBy("attribute_id").agg(F.count(F.lit(1)).alias("n"), *[v.alias(c) for c, v in n.items()], F.avg((F.col("case") == "equal").cast("int")).alias("raw_agreement"))


def adjudicated(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Shares of each attribute in which model and sheet are right. A verdict that is missing or unknown is an error."""
    v = verdicts.withColumn("verdict", normalized("verdict"))
    if bad := v.where(~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))).count():
        raise ValueError(f"{bad} pairs without a valid verdict")
    out = pairs.join(v.select(*KEY, "verdict"), KEY, "left")
    right = lambda who: F.coalesce((F.col("case") == "equal") | F.col("verdict").isin(who, "both"), F.lit(False))
    out = out.withColumns({"_m": right("model"), "_s": right("sheet")})
    share = lambda c: F.avg(F.col(c).cast("int"))
    return out.groupBy("attribute_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("_m")).alias("model_errors"), share("_m").alias("model_right"), share("_s").alias("sheet_right"))


def round_measures(calls: DataFrame, contexts: DataFrame, costs: DataFrame) -> DataFrame:
    """By work: calls, escalated ones, those that found something, the context's source, and the cost."""
    c = calls.groupBy("work_id").agg(F.count(F.lit(1)).alias("calls"), F.count_if("escalated").alias("escalated"), F.count_if(F.col("escalated") & F.col("found")).alias("escalated_found"))
    u = costs.groupBy("work_id").agg(F.sum("usd").alias("usd"), F.max("seconds").alias("seconds"))
    return c.join(contexts.select("work_id", "basis"), "work_id", "full").join(u, "work_id", "full")


def checked_sheet(sheet: DataFrame, accepted: DataFrame) -> DataFrame:
    """A filled check sheet (id, attribute_id, right_value, place, sentence) squished, with `checked`. Repeated ids and values out of their
    lists are errors that name the ids. accepted: attribute_id, values (an array)."""
    for c in ("right_value", "place", "sentence"):
        sheet = sheet.withColumn(c, F.nullif(squish(c), F.lit("")))
    if sheet.groupBy("id").count().where("count > 1").limit(1).count():
        raise ValueError("repeated id")
    out = sheet.join(accepted, "attribute_id", "left")
    bad_value = ~F.coalesce(F.array_contains("values", F.col("right_value")), F.lit(False)) & ~F.col("right_value").isin(NOT_TOLD, OTHER)
    checks = {"right_value": bad_value, "place": ~F.col("place").isin(*WHERE), "sentence": ~F.col("sentence").isin(*RIGHT_SENTENCE)}
    for c, bad in checks.items():
        if ids := [r.id for r in out.where(F.col(c).isNotNull() & bad).select("id").orderBy("id").limit(20).collect()]:
            raise ValueError(f"{c} not in its list: {', '.join(map(str, ids))}")
    return out.drop("values").withColumn("checked", F.col("right_value").isNotNull())


def marked(values: Column | str, right: Column | str) -> Column:
    """right, partial, wrong or not_found, of values (separated by |) against the right one. Told nothing is right where nothing is told."""
    v = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(values, F.lit("")), r"\|"), normalized), lambda x: (x != "") & (x != "na")))
    r = F.col(right) if isinstance(right, str) else right
    told = F.when(F.size(v) == 0, "not_found").when((F.size(v) == 1) & (v[0] == F.lower(r)), "right").when(F.array_contains(v, F.lower(r)), "partial").otherwise("wrong")
    return F.when(r == NOT_TOLD, F.when(F.size(v) > 0, "wrong").otherwise("right")).otherwise(told)


def check_scores(sheet: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both sides of checked rows marked: KEY, block, model, reference (null where the right value is another one)."""
    rows = sheet.where("checked").join(pairs.select(*KEY, "sheet_value", "model_value"), KEY, "left")
    can = F.col("right_value") != OTHER
    return rows.withColumns({"model": F.when(can, marked("model_value", "right_value")), "reference": F.when(can, marked("sheet_value", "right_value"))})


def check_summary(scores: DataFrame) -> DataFrame:
    n = lambda c, v: F.count_if(F.col(c) == v)
    return scores.groupBy("block", "attribute_id").agg(
        F.count(F.lit(1)).alias("n_checked"), n("right_value", OTHER).alias("other"), *[n("model", v).alias(f"model_{v}") for v in ("right", "partial", "not_found", "wrong")],
        n("reference", "right").alias("reference_right"), n("sentence", "no").alias("sentence_of_another"), n("place", "figure").alias("only_in_figure"),
    )


def repeated_evidence(pairs: DataFrame) -> DataFrame:
    """KEY of equal pairs whose evidence, with a digit in it, serves several entities of a work and attribute."""
    s = pairs.where("evidence IS NOT NULL").withColumn("sentence", F.explode(F.split("evidence", r" \|\| "))).where(F.col("sentence").rlike("[0-9]"))
    several = s.groupBy("work_id", "attribute_id", "sentence").agg(F.countDistinct("entity_id").alias("_n")).where("_n > 1").drop("_n")
    return s.where("case = 'equal'").join(several, ["work_id", "attribute_id", "sentence"], "left_semi").select(*KEY).distinct()


def check_blocks(pairs: DataFrame, n: int, least: int, seed: int) -> DataFrame:
    """Pairs to check with their block: 1 what is not equal, 2 equal ones with repeated evidence and a sample of the others by work."""
    pairs = settled(pairs, "pairs")  # it is read five times
    doubtful = repeated_evidence(pairs)
    equal = pairs.where("case = 'equal'")
    sample = stratified(equal.join(doubtful, KEY, "left_anti"), "work_id", n, least, seed, "entity_id", "attribute_id")
    second = equal.join(doubtful, KEY, "left_semi").unionByName(sample)
    return pairs.where("case <> 'equal'").withColumn("block", F.lit("1")).unionByName(second.withColumn("block", F.lit("2")))


def name_in_article(text: Column, accepted: Column, names: Column) -> Column:
    """Empty if the accepted name stands there, else the name that occurs most (the first of several), else not found."""
    t = squish(text)
    # occurrences without overlap, of the literal name
    n = lambda x: (F.length(t) - F.length(F.replace(t, x, F.lit("")))) / F.length(x)
    others = F.array_except(names, F.array(accepted))
    counts = F.transform(others, lambda x, i: F.struct(n(x).alias("n"), (-i).alias("i"), x.alias("x")))
    best = F.array_max(counts)
    return F.when(F.contains(t, accepted), "").when(best["n"] > 0, best["x"]).otherwise("(not found)")


def pages_of(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """spans (work_id, span_id, span) with the pages that hold the span: whole, else its first 45 characters, else its last; one page, else
    over two. `?` for none or more than three. Spans meet the pages of their own work only."""
    p = pages.select("work_id", "page", page_key("text").alias("_t"))
    p = p.withColumn("_two", F.concat("_t", F.lead("_t", 1, "").over(Window.partitionBy("work_id").orderBy("page"))))
    key = page_key("span")
    probes = F.array_distinct(F.array(key, F.substring(key, 1, 45), F.right(key, F.lit(45))))
    s = spans.select("work_id", "span_id", F.posexplode(F.filter(probes, lambda x: F.length(x) >= 15)).alias("_o", "_s"))
    hits = s.join(p, "work_id").withColumn("_h", F.when(F.contains("_t", F.col("_s")), 0).when(F.contains("_two", F.col("_s")), 1)).where("_h IS NOT NULL")
    first = hits.groupBy("work_id", "span_id").agg(F.min(F.struct("_o", "_h")).alias("_b"))
    kept = hits.join(first, ["work_id", "span_id"]).where("_o = _b._o AND _h = _b._h").groupBy("work_id", "span_id").agg(F.array_sort(F.collect_set("page")).alias("_p"))
    out = spans.join(kept, ["work_id", "span_id"], "left")
    text = F.when(F.col("_p").isNull() | (F.size("_p") > 3), "?").otherwise(F.array_join(F.transform("_p", lambda x: x.cast("string")), "/"))
    return out.withColumn("pages", F.when(F.coalesce("span", F.lit("")) == "", "").otherwise(text)).drop("_p")


def pages_of_name(names: DataFrame, pages: DataFrame, most: int = 5) -> DataFrame:
    """work_id, name and pages: up to five page numbers that hold the name, ... if there are more; empty if none."""
    hits = names.join(pages, "work_id").where(F.contains(page_key("text"), page_key("name"))).groupBy("work_id", "name").agg(F.array_sort(F.collect_set("page")).alias("_p"))
    out = names.select("work_id", "name").distinct().join(hits, ["work_id", "name"], "left")
    listed = F.concat(F.lit("name on p. "), F.array_join(F.transform(F.slice("_p", 1, most), lambda x: x.cast("string")), ", "), F.when(F.size("_p") > most, " …").otherwise(""))
    return out.select("work_id", "name", F.when(F.col("_p").isNull(), "").otherwise(listed).alias("pages"))


def file_name_of(citation: Column | str) -> Column:
    """A citation as a file name: letters and digits, other runs as one underscore."""
    return F.regexp_replace(F.regexp_replace(citation, r"[^\p{L}\p{N}]+", "_"), "^_|_$", "")


def eye_position(sentence: Column | str) -> Column:
    s = F.regexp_replace(F.lower(sentence), r"(dorso)?laterally directed|dorsally directed|directed (dorso)?laterally|directed dorsally|oriented (dorso)?lateral(ly)?|oriented dorsal(ly)?", "")
    return F.when(s.contains("dorsolateral"), "dorsolateral").when(s.contains("dorsal"), "dorsal").when(s.contains("lateral"), "lateral")


def has_direction(sentence: Column | str) -> Column:
    return F.lower(sentence).rlike("directed|oriented")


def position_rule(sheet: DataFrame, sentences: DataFrame) -> DataFrame:
    """sheet with right_value set to the position a sentence (id, sentence) tells apart from the direction, and `changed`."""
    out = sheet.join(sentences, "id", "left").withColumn("_p", eye_position("sentence"))
    swap = has_direction("sentence") & F.col("_p").isNotNull() & F.col("right_value").isin("dorsal", "lateral", "dorsolateral") & (F.col("_p") != F.col("right_value"))
    out = out.withColumn("changed", F.coalesce(swap, F.lit(False)))
    return out.withColumn("right_value", F.when(F.col("changed"), F.col("_p")).otherwise(F.col("right_value"))).drop("_p")


def observed_values(measurements: DataFrame, taxa: DataFrame) -> DataFrame:
    """attribute_id, value, number of records and up to three entities by name; diet items are values of one attribute, | separates several."""
    item = F.regexp_extract("attribute_id", "^diet_item:(.*)$", 1)
    rows = measurements.withColumns({"_a": F.when(F.col("attribute_id").startswith("diet_item:"), "diet_composition").otherwise(F.col("attribute_id")), "_v": F.when(F.col("attribute_id").startswith("diet_item:"), item).otherwise(F.col("value"))})
    rows = rows.select(F.col("_a").alias("attribute_id"), "entity_id", F.explode(F.split("_v", r"\|")).alias("value")).withColumn("value", squish("value")).where("value <> ''")
    rows = rows.join(taxa.select("entity_id", "entity"), "entity_id", "left")
    return rows.groupBy("attribute_id", "value").agg(F.count(F.lit(1)).alias("n_records"), F.array_join(F.slice(F.array_sort(F.collect_set("entity")), 1, 3), "; ").alias("examples"))


def listed_values(values: DataFrame, most: int = 25) -> DataFrame:
    """attribute_id and its commonest values by falling count, `[+n others]` for the rest."""
    counts = values.withColumn("value", squish("value")).where("value IS NOT NULL").groupBy("attribute_id", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumns({"_k": F.row_number().over(Window.partitionBy("attribute_id").orderBy(F.desc("n"), "value")), "_n": F.count(F.lit(1)).over(Window.partitionBy("attribute_id"))})
    few = ranked.where(F.col("_k") <= most).groupBy("attribute_id", "_n").agg(F.array_sort(F.collect_list(F.struct("_k", "value"))).alias("_l"))
    rest = F.when(F.col("_n") > most, F.concat(F.lit(" [+"), (F.col("_n") - most).cast("string"), F.lit(" others]"))).otherwise("")
    return few.select("attribute_id", F.concat(F.array_join(F.transform("_l", lambda x: x["value"]), ";"), rest).alias("values"))


def attribute_profile(measurements: DataFrame, present: DataFrame) -> DataFrame:
    """For each attribute its records, kind (numeric if over 0.8 of the values are numbers) and unit; fields set by hand stay."""
    number = squish("value").rlike(r"^-?[0-9]+([.,][0-9]+)?$").cast("int")
    p = measurements.groupBy("attribute_id").agg(F.count(F.lit(1)).alias("n_records"), F.avg(number).alias("_s"), F.min("unit").alias("_u"))
    out = p.join(present.select("attribute_id", F.col("kind").alias("_k"), F.col("unit").alias("_o")), "attribute_id", "left")
    return out.select("attribute_id", "n_records", F.coalesce("_k", F.when(F.col("_s") > 0.8, "numeric").otherwise("categorical")).alias("kind"), F.coalesce("_o", "_u").alias("unit"))


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose rows differ in any of the columns, nulls being equal."""
    b = before.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return after.join(b, key).where(~same).select(key)


def round_extractions(extractions: DataFrame, chunks: DataFrame) -> DataFrame:
    """Extractions that are not rejected, with the section of their chunk where there is one."""
    return extractions.where("status <> 'rejected'").join(chunks.select("chunk_id", "section"), "chunk_id", "left")


def corpus_sheet(extractions: DataFrame, targets: DataFrame, works: DataFrame) -> DataFrame:
    """A row to check for each pair of raw and conflicting extractions: its values and evidence, block 1 for conflicts, a short citation."""
    rows = extractions.where(F.col("status").isin("raw", "conflict")).join(targets.select("entity_id", "entity"), "entity_id")
    joined = lambda c, sep: F.array_join(F.array_sort(F.collect_set(c)), sep)
    rows = dealt(rows.select(*KEY, "entity", "value_cat", "evidence", "status"), "work_id")  # first, so that no task gathers the sets of a whole split
    pairs = rows.groupBy(*KEY, "entity").agg(joined("value_cat", " | ").alias("model_value"), joined("evidence", SEVERAL).alias("evidence"), F.bool_or(F.col("status") == "conflict").alias("_c"))
    cited = works.select("work_id", F.concat(F.when(F.length(squish("title")) > 70, F.concat(F.substring(squish("title"), 1, 67), F.lit("..."))).otherwise(squish("title")), F.lit(" ("), F.col("year").cast("string"), F.lit(")")).alias("citation"))
    return pairs.join(dealt(cited, "work_id"), "work_id").withColumns({"case": F.when(F.col("_c"), "conflict").otherwise("extracted"), "block": F.when(F.col("_c"), "1").otherwise("2")}).drop("_c")


def vocabulary_sheet(attributes: DataFrame, values: DataFrame) -> DataFrame:
    """Attributes still open with the number and list of their observed values, in the order in which to decide: words, numbers, new ones."""
    seen = values.groupBy("attribute_id").agg(F.count(F.lit(1)).alias("n_values"), F.array_join(F.array_sort(F.collect_set("value")), ";").alias("observed"))
    group = F.when(F.col("origin") == "to_define", 3).when(F.col("kind") == "numeric", 2).otherwise(1)
    return attributes.where("status <> 'closed'").join(seen, "attribute_id", "left").select("attribute_id", "kind", "n_values", F.coalesce("observed", F.lit("")).alias("observed"), group.alias("group"))
