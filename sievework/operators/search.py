"""Literature search, triage and acquisition. Services are providers: functions from a batch of rows to rows, faked where there is no network.

A provider is called by executors, in as many tasks as the caller allows at once. A failed call is never "not found": it gives a row whose
`error` says why, and what follows keeps such rows apart.
"""

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import content_id, squish
from sievework.sources.tables import dealt, settled

from .names import pattern_of
from .targets import first_rows
from .upsert import replace

#: Search terms by language, record types that are let in, and what a landing page's address tells of its type.
TERMS = {"pt": 'girino OR larva OR "desenvolvimento larval"', "es": 'renacuajo OR larva OR "desarrollo larval"', "en": 'tadpole OR larva OR "larval development"'}
OPEN_TYPES = ("article", "review", "book", "book-chapter", "dissertation", "preprint", "report")
REGISTRY_TYPES = ("journal-article", "book", "book-chapter", "book-part", "book-section", "edited-book", "monograph", "dissertation", "posted-content", "report")
URL_TYPES = {"poster": r"(?i)^https?://(www\.)?f1000research\.com/posters/", "conference_abstract": r"(?i)^https?://(www\.)?f1000research\.com/(slides|documents)/"}
MARGIN = (0.35, 0.75)
HUMAN, FOUND = "human_queue", "found"
FILLED = ["doi", "title", "year", "page_url", "abstract"]


def provided(rows: DataFrame, provider: Callable, schema: str, at_once: int = 4) -> DataFrame:
    """provider(list of rows as dicts) -> list of dicts, over rows in `at_once` partitions, so that a service is not asked by more tasks."""

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def ask(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield from pa.Table.from_pylist(provider(batch.to_pylist()), arrow).to_batches()

    return rows.repartition(at_once).mapInArrow(ask, schema)


def queries_for(targets: DataFrame, languages: list[str]) -> DataFrame:
    """A query for each entity and language: "name" AND (terms)."""
    terms = F.explode(F.array(*[F.struct(F.lit(k).alias("language"), F.lit(TERMS[k]).alias("terms")) for k in languages]))
    return targets.withColumn("_t", terms).select("entity_id", "entity", "_t.language", F.concat(F.lit('"'), "entity", F.lit('" AND ('), "_t.terms", F.lit(")")).alias("query"))


def abstract_of(index: Column) -> Column:
    """The text of an inverted index (word -> positions); null for an empty one."""
    places = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.when(F.size(index) > 0, F.array_join(F.transform(F.array_sort(places), lambda x: x["w"]), " "))


def clean_abstract(c: Column | str) -> Column:
    """Without tags; null for what is empty then."""
    return F.nullif(squish(F.regexp_replace(c, r"<[^>]+>", " ")), F.lit(""))


def open_record(raw: Column | str) -> Column:
    """doi, title, year, type and abstract of a work record in JSON: nested paths, null where a level is missing."""
    j = F.from_json(raw, "id string, doi string, title string, publication_year int, type string, locations array<struct<pdf_url:string>>, abstract_inverted_index map<string,array<int>>")
    return F.struct(F.regexp_replace(F.lower(j["doi"]), "^https?://(dx\\.)?doi\\.org/", "").alias("doi"), j["title"].alias("title"), j["publication_year"].alias("year"), j["type"].alias("type"), F.try_element_at(j["locations"], F.lit(1))["pdf_url"].alias("pdf_url"), abstract_of(j["abstract_inverted_index"]).alias("abstract"))


def allowed(records: DataFrame, types: tuple[str, ...] = OPEN_TYPES) -> DataFrame:
    return records.where(F.col("type").isin(*types))


def title_names(titles: DataFrame, names: DataFrame, title: str = "title") -> DataFrame:
    """titles (entity_id, title) with cites: whether the title, without tags, has one of the entity's names as words. names: entity_id, names."""
    out = titles.join(names.select("entity_id", pattern_of(F.col("names")).alias("_p")), "entity_id", "left")
    return out.withColumn("cites", F.coalesce(F.expr(f"trim(regexp_replace(regexp_replace(coalesce({title}, ''), '<[^>]+>', ' '), '\\\\s+', ' ')) rlike concat('(?i)', _p, '\\\\b')"), F.lit(False))).drop("_p")


def found_works(records: DataFrame, order: list) -> tuple[DataFrame, DataFrame]:
    """(links, works) of records (entity_id, doi, title, year, page_url, abstract): links before works are made distinct; the first row of a
    work in `order` counts, with the first known abstract and address."""
    rows = records.withColumn("doi", F.lower("doi")).withColumn("_key", F.coalesce("doi", F.lower("title"))).where("_key IS NOT NULL").withColumn("work_id", content_id("_key"))
    links = rows.select("work_id", "entity_id").distinct()
    every = Window.partitionBy("work_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({c: F.first(c, ignorenulls=True).over(every) for c in ("abstract", "page_url")})
    works = first_rows(rows, ["work_id"], order).select("work_id", "doi", "title", "year", "page_url", "abstract", F.lit(FOUND).alias("status"))
    return links, works


def search_log(queries: DataFrame, links: DataFrame) -> DataFrame:
    """A row for each query with the number of works found for its entity."""
    n = links.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_results"))
    return queries.join(n, "entity_id", "left").select(content_id("entity_id", "language", "query").alias("search_id"), "entity_id", "language", "query", F.coalesce("n_results", F.lit(0)).alias("n_results"))


def type_of_url(url: Column | str) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return reduce(lambda a, kv: a.when(u.rlike(kv[1]), kv[0]), list(URL_TYPES.items())[1:], F.when(u.rlike(URL_TYPES["poster"]), "poster"))


def typed_by_url(works: DataFrame) -> DataFrame:
    """A document type where there is none; one set by hand stays."""
    return works.withColumn("document_type", F.coalesce("document_type", type_of_url("page_url")))


def named_in_title(works: DataFrame, links: DataFrame, names: DataFrame) -> DataFrame:
    """works with named: whether the title names any linked entity. Works and links are dealt alike, so that joins and groups stay in small parts."""
    works, links = dealt(works, "work_id"), dealt(links, "work_id")
    hits = title_names(links.join(works.select("work_id", "title"), "work_id"), names).groupBy("work_id").agg(F.bool_or("cites").alias("named"))
    return works.join(hits, "work_id", "left").withColumn("named", F.coalesce("named", F.lit(False)))


def triage_decision(answers: DataFrame, model: str, margin: tuple[float, float] = MARGIN) -> DataFrame:
    """answers (work_id, relevant, prob, why, error) as triage rows: no answer leaves relevance null; it, and a probability that is missing
    or within the margin (bounds included), go to people."""
    none = F.col("error").isNotNull() | F.col("relevant").isNull()
    by = F.when(none | F.coalesce(F.col("prob").between(*margin), F.lit(True)), HUMAN).otherwise(F.lit(f"agent:{model}"))
    why = F.when(none, F.concat(F.lit("no answer: "), F.coalesce("error", F.lit("empty")))).otherwise(F.col("why"))
    return answers.select("work_id", F.when(~none, F.col("relevant")).alias("relevant"), F.when(~none, F.col("prob")).alias("prob"), why.alias("why"), by.alias("decided_by"))


def triaged(works: DataFrame, links: DataFrame, names: DataFrame, ask: Callable, model: str) -> DataFrame:
    """Works whose title names an entity are relevant by rule; the others are asked for (ask: DataFrame -> answers)."""
    marked = settled(named_in_title(works, links, names), "marked")  # it is read twice
    ruled = marked.where("named").select("work_id", F.lit(True).alias("relevant"), F.lit(1.0).alias("prob"), F.lit("name in title").alias("why"), F.lit("rule:name_in_title").alias("decided_by"))
    return ruled.unionByName(triage_decision(ask(marked.where("NOT named")), model))


def human_queue(triage: DataFrame, works: DataFrame) -> DataFrame:
    return triage.where(F.col("decided_by") == HUMAN).join(works.select("work_id", "title"), "work_id").orderBy(F.desc_nulls_last("prob"), "work_id")


def human_answers(triage: DataFrame, sheet: DataFrame, reviewer: str) -> DataFrame:
    """triage with the yes and no rows of a sheet (work_id, decision) put in their place."""
    a = sheet.where(F.col("decision").isin("yes", "no")).select("work_id", (F.col("decision") == "yes").alias("relevant"), "prob", "why", F.lit(reviewer).alias("decided_by"))
    return replace(triage, a, ["work_id"])


def is_pdf(content: Column | str) -> Column:
    """Whether %PDF- stands in the first 1,024 bytes."""
    return F.locate("%PDF-", F.decode(F.substring(content, 1, 1024), "ISO-8859-1")) > 0


def needs_ocr(text: Column | str, least: int = 2000) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s", "")) < least


def acquisition_status(path: Column, error: Column, scanned: Column, ocr: Column) -> Column:
    return F.when(path.isNull() & error.isNotNull(), "error").when(path.isNull(), "no_pdf").when(scanned & ~ocr, "needs_ocr").when(ocr, "pdf_ocr").otherwise("pdf_ok")


def to_acquire(works: DataFrame, triage: DataFrame) -> DataFrame:
    return works.where("path IS NULL").join(triage.where("relevant").select("work_id"), "work_id", "left_semi")


def without_pdf(works: DataFrame, seed: str = "seed") -> DataFrame:
    """Works without a file: an open link, and for seeds the page of the full text."""
    return works.where("status = 'no_pdf'").select("work_id", "title", "year", F.coalesce("pdf_url", "supplement_url").alias("open_link"), F.when(F.col("source") == seed, F.col("page_url")).alias("full_text_link"))


def manual_files(sheet: DataFrame, works: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of a sheet (work_id, doi, file) with the work they belong to, by id or else by doi in any case, and what is wrong with them.

    files: file, is_pdf. Blank files take no part.
    """
    rows = sheet.where(F.coalesce(F.trim("file"), F.lit("")) != "").withColumn("file", F.trim("file"))
    by_id = works.select(F.col("work_id").alias("_id")).distinct()
    by_doi = works.where("doi IS NOT NULL").groupBy(F.lower("doi").alias("_doi")).agg(F.min("work_id").alias("_of_doi"))
    rows = rows.join(by_id, F.col("work_id") == F.col("_id"), "left").join(by_doi, F.lower(F.trim("doi")) == F.col("_doi"), "left")
    rows = rows.withColumn("_work", F.coalesce("_id", "_of_doi")).join(files, "file", "left")
    problem = F.when(F.col("_work").isNull(), "unknown work").when(F.col("is_pdf").isNull(), "file not found").when(~F.col("is_pdf"), "no pdf")
    return rows.select(F.coalesce("_work", "work_id").alias("work_id"), "file", problem.alias("problem"))


def placed(works: DataFrame, manual: DataFrame) -> DataFrame:
    """works with the path and status of the files that have no problem; of several the first by name."""
    good = manual.where("problem IS NULL").groupBy("work_id").agg(F.min("file").alias("_file"))
    out = works.join(good, "work_id", "left")
    return out.withColumns({"path": F.coalesce("_file", "path"), "status": F.when(F.col("_file").isNotNull(), "pdf_manual").otherwise(F.col("status"))}).drop("_file")
