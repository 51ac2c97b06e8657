"""The sheet on which people check values against the articles: where a sentence stands, how the article names the entity, and the workbook.

Pages are (work_id, page, text); names are (work_id, entity_id, name, place), place being the name's place among those of its entity. Pages
and names meet within their work only, and an article is never gathered: names are counted page by page and over the page breaks.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import page_key, squish
from sievework.sources.workbooks import Look, write_workbook

from .pilot import KEY, NOT_TOLD, OTHER, RIGHT_SENTENCE, SEVERAL, WHERE, check_blocks, corpus_sheet, file_name_of, pages_of, pages_of_name
from .scan import scanned

NOT_FOUND = "(not found)"
#: What is said of a case.
SITUATION = {"differs": "values differ", "only_sheet": "only the sheet has a value", "only_model": "only the model has a value", "equal": "equal", "conflict": "several values", "extracted": "extracted"}


def names_in_articles(pairs: DataFrame, pages: DataFrame, names: DataFrame) -> DataFrame:
    """work_id, entity_id and name_in_article: empty if the article has the accepted name (pairs.entity), else the other name that stands
    there most (the first of several), else NOT_FOUND. Literal, with white space squeezed."""
    asked = pairs.select("work_id", "entity_id", "entity").distinct()
    text = pages.select("work_id", "page", squish(F.coalesce("text", F.lit(""))).alias("t"))
    after = F.lead("t").over(Window.partitionBy("work_id").orderBy("page"))
    text = text.withColumn("next", after)
    every = asked.select("work_id", "entity_id", F.col("entity").alias("name"), F.lit(-1).alias("place"))
    every = every.unionByName(names.join(asked, ["work_id", "entity_id"]).where("name <> entity AND name <> ''").select("work_id", "entity_id", "name", "place"))
    count = lambda t: (F.length(t) - F.length(F.replace(t, F.col("name"), F.lit("")))) / F.length("name")
    over = F.concat(F.right("t", F.length("name") - 1), F.lit(" "), F.substring(F.col("next"), F.lit(1), F.length("name") - 1))
    counts = every.join(text, "work_id").groupBy("work_id", "entity_id", "name", "place").agg(F.sum(count(F.col("t")) + F.coalesce(count(over), F.lit(0.0))).alias("n")).where("n > 0")
    best = counts.groupBy("work_id", "entity_id").agg(F.max(F.col("place") == -1).alias("accepted"), F.min_by("name", F.struct(-F.col("n"), "place")).alias("other"))
    out = asked.join(best, ["work_id", "entity_id"], "left")
    return out.select("work_id", "entity_id", F.when(F.col("accepted"), "").otherwise(F.coalesce("other", F.lit(NOT_FOUND))).alias("name_in_article"))


def evidence_pages(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """KEY and pages: for each sentence of the evidence its pages (as pages_of), with the number of the first table named on the first page
    if the sentence is a row of cells; empty without evidence."""
    spans = pairs.select(*KEY, F.posexplode(F.split(F.coalesce("evidence", F.lit("")), r" \|\| ")).alias("at", "span"))
    spans = spans.withColumn("span_id", F.struct("entity_id", "attribute_id", "at"))
    found = pages_of(spans.select("work_id", "span_id", "span"), pages).select("work_id", "span_id", "span", "pages")
    row = F.col("span").rlike(r"\S {3,}\S") & F.col("pages").rlike("^[0-9]")
    first = F.split("pages", "/")[0]
    tables = pages.select("work_id", F.col("page").cast("string").alias("first"), F.nullif(F.regexp_extract(page_key("text"), "table([0-9]+)", 1), F.lit("")).alias("table"))
    found = found.withColumn("first", F.when(row, first)).join(tables, ["work_id", "first"], "left")
    told = F.concat("pages", F.when(F.col("table").isNull(), "").otherwise(F.concat(F.lit(" (table "), "table", F.lit(")"))))
    lists = found.groupBy("work_id", "span_id.entity_id", "span_id.attribute_id").agg(F.array_sort(F.collect_list(F.struct(F.col("span_id.at").alias("at"), told.alias("pages")))).alias("l"))
    return lists.select(*KEY, F.array_join(F.transform("l", lambda x: x["pages"]), SEVERAL).alias("pages"))


def with_places(pairs: DataFrame, pages: DataFrame, names: DataFrame) -> DataFrame:
    """pairs (KEY, entity, evidence and others) with name_in_article and page: the evidence's pages, else those of the name."""
    known = pairs.join(names_in_articles(pairs, pages, names), ["work_id", "entity_id"]).join(evidence_pages(pairs, pages), KEY)
    said = F.when(F.col("name_in_article").isin("", NOT_FOUND), F.col("entity")).otherwise(F.col("name_in_article"))
    known = known.withColumn("name", said)
    places = pages_of_name(known.select("work_id", "name").distinct(), pages).withColumnRenamed("pages", "name_pages")
    return known.join(places, ["work_id", "name"], "left").withColumn("page", F.when(F.col("pages").isin("", "?"), F.col("name_pages")).otherwise(F.col("pages"))).drop("name", "pages", "name_pages")


def numbered(rows: DataFrame, letter: str) -> DataFrame:
    """rows with an id by article, entity and attribute, so that the attributes of an entity stand together."""
    out = scanned(rows, ["citation", "entity", "attribute_id", "entity_id"], number="place_")
    return out.withColumn("id", F.concat(F.lit(letter), F.lpad(F.col("place_").cast("string"), F.greatest(F.lit(3), F.length(F.col("place_").cast("string"))), F.lit("0"))))


def check_rows(pairs: DataFrame, reference: DataFrame, pages: DataFrame, names: DataFrame, n: int, least: int, seed: int) -> DataFrame:
    """The rows of a round's sheet: what check_blocks chooses of the pairs, the case of another round, where it stands, and ids."""
    rows = check_blocks(pairs, n, least, seed).join(reference.select(*KEY, F.col("case").alias("case_ref")), KEY, "left")
    return numbered(with_places(rows, pages, names), "R")


def corpus_check_rows(extractions: DataFrame, targets: DataFrame, works: DataFrame, pages: DataFrame, names: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """The rows of a corpus sheet: every pair with a raw or conflicting value, or those of `only` (KEY). None is an error."""
    chosen = extractions if only is None else extractions.join(only.select(*KEY).distinct(), KEY, "left_semi")
    rows = corpus_sheet(chosen, targets, works)
    if not rows.take(1):
        raise ValueError("there is nothing to check")
    blank = {"sheet_value": F.lit(""), "case_ref": F.lit(None).cast("string")}
    return numbered(with_places(rows, pages, names).withColumns(blank), "C")


def write_check_workbook(path: str, rows: DataFrame, attributes: DataFrame, read_me: list[str], most: int = 20_000) -> dict[str, int]:
    """A workbook of a note and the rows to check, with lists for the answers; gives the number of rows.

    attributes: attribute_id, name, accepted (separated by ;). {n}, {n_articles}, {n1} and {n2} in the note are the numbers of rows, of
    articles and of the rows of each block. A path that exists and more rows than `most` are errors.
    """
    situation = F.coalesce(F.create_map(*[F.lit(x) for kv in SITUATION.items() for x in kv])[F.col("case")], F.col("case"))
    named = rows.join(attributes.select("attribute_id", F.col("name").alias("attribute")), "attribute_id", "left")
    seen = {
        "id": F.col("id"), "block": F.col("block"), "article": F.col("citation"), "file": F.concat(file_name_of("citation"), F.lit(".pdf")), "page": F.col("page"), "entity": F.col("entity"), "name_in_article": F.col("name_in_article"),
        "attribute": F.coalesce("attribute", "attribute_id"), "situation": situation, "sheet_value": F.coalesce("sheet_value", F.lit("")), "model_value": F.coalesce("model_value", F.lit("")), "evidence": F.coalesce("evidence", F.lit("")),
        "right_value": F.lit(""), "place": F.lit(""), "sentence": F.lit(""), "note": F.lit(""), "work_id": F.col("work_id"), "entity_id": F.col("entity_id"), "attribute_id": F.col("attribute_id"), "case": F.col("case"), "case_ref": F.col("case_ref"),
    }
    table = named.orderBy("place_").select(*[c.alias(n) for n, c in seen.items()])
    few = table.select("attribute_id", "article", "block").limit(most + 1).collect()
    accepted = {r.attribute_id: [v for v in (x.strip() for x in (r.accepted or "").split(";")) if v] for r in attributes.select("attribute_id", "accepted").collect()}  # a vocabulary
    lists: dict = {"place": list(WHERE), "sentence": list(RIGHT_SENTENCE)}
    lists |= {("right_value", k): [*accepted.get(r.attribute_id, []), NOT_TOLD, OTHER] for k, r in enumerate(few, 1)}
    numbers = {"n": len(few), "n_articles": len({r.article for r in few}), "n1": sum(r.block == "1" for r in few), "n2": sum(r.block == "2" for r in few)}
    note = list(read_me)
    for k, v in numbers.items():
        note = [x.replace(f"{{{k}}}", str(v)) for x in note]
    wide = {"article": 22, "file": 24, "entity": 26, "evidence": 60, "note": 40, "id": 7, "block": 7}
    look = Look(lists=lists, hidden=("work_id", "entity_id", "attribute_id", "case", "case_ref"), answer=("right_value", "place", "sentence", "note"), widths=wide, frozen="name_in_article", message="Choose a value of the list; if none fits, take the last one and say why in the note.")
    return write_workbook(path, {"READ ME": note, "review": table}, {"review": look}, most)
