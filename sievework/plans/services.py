"""Queries of the service providers, with a fake service that answers from the row it is asked about."""

from functools import partial

from pyspark.sql import functions as F

from sievework.operators import search
from sievework.sources import providers
from sievework.sources.tables import read

from .registry import query


def _fake(url: str, params: dict) -> tuple[int, dict]:
    """Two pages of open records, registry items of two types, no answer for library calls, known and unknown dois."""
    if url == providers.OPEN_RECORDS:
        word = params["search"]
        if params["cursor"] == "*":
            return 200, {"results": [{"type": "article", "doi": f"https://doi.org/10.1/{word}", "title": word, "publication_year": 2000, "abstract_inverted_index": {"b": [1], "a": [0, 2]}}, {"type": "paratext", "title": "no"}], "meta": {"next_cursor": "2"}}
        return 200, {"results": [{"type": "book", "title": f"{word} two", "primary_location": {"pdf_url": "http://p"}}], "meta": {"next_cursor": None}}
    if url == providers.REGISTRY:
        word = params["query.bibliographic"]
        return 200, {"message": {"items": [{"type": "journal-article", "DOI": f"10.2/{word}", "title": [word], "issued": {"date-parts": [[1999, 1]]}, "author": [{"family": "Silva"}]}, {"type": "component", "title": ["no"]}]}}
    doi = url.rsplit("/", 1)[-1]
    if doi.endswith("7"):
        return 500, {}
    return (404, {}) if doi.endswith("3") else (200, {"best_oa_location": {"url_for_pdf": f"http://f/{doi}"}})


def _fetch():
    return providers.patient(_fake, sleep=lambda s: None)


def _searched(rows: list[dict]) -> list[dict]:
    fetch, out = _fetch(), []
    for r in rows:
        for p in (partial(providers.open_records, fetch, r["word"], "en", search.OPEN_TYPES), partial(providers.registry_records, fetch, r["word"], search.REGISTRY_TYPES), partial(providers.library_records, fetch, r["word"], "")):
            out += [{"id": r["id"], **{c: x.get(c) for c in ("doi", "title", "year", "pdf_url", "abstract", "source")}} for x in p()]
    return out


@query("""SELECT s_suppkey AS id, lower('10.1/' || s_name) AS doi, s_name AS title, 2000 AS year, NULL AS pdf_url, 'a b a' AS abstract, 'open' AS source FROM supplier
    UNION ALL SELECT s_suppkey, NULL, s_name || ' two', NULL, 'http://p', NULL, 'open' FROM supplier UNION ALL SELECT s_suppkey, lower('10.2/' || s_name), s_name, 1999, NULL, NULL, 'registry' FROM supplier""")
def provider_search(spark, sf_dir):
    asked = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS word")
    return search.provided(asked, _searched, "id long, doi string, title string, year int, pdf_url string, abstract string, source string")


def _located(rows: list[dict]) -> list[dict]:
    fetch = _fetch()
    return [{"id": r["id"], "exists": providers.doi_exists(fetch, r["doi"]), **{k: v for k, v in providers.open_access(fetch, r["doi"]).items() if k != "page"}} for r in rows]


@query("""SELECT p_partkey AS id, CASE WHEN d LIKE '%7' THEN NULL ELSE d NOT LIKE '%3' END AS exists, CASE WHEN d NOT LIKE '%7' AND d NOT LIKE '%3' THEN 'http://f/' || d END AS pdf,
    CASE WHEN d LIKE '%7' THEN 'https://api.unpaywall.org/v2/' || d || ': status 500' END AS error FROM (SELECT p_partkey, 'd' || p_partkey AS d FROM part)""")
def provider_open_access(spark, sf_dir):
    asked = read(spark, sf_dir, "part").selectExpr("p_partkey AS id", "concat('d', p_partkey) AS doi")
    return search.provided(asked, _located, "id long, exists boolean, pdf string, error string")


@query("""SELECT p_partkey AS id, CASE WHEN p_size < 10 THEN 'error' WHEN p_size < 20 THEN 'no_pdf' WHEN p_size < 30 THEN 'needs_ocr' ELSE 'pdf_ok' END AS status FROM part""")
def acquired_files(spark, sf_dir):
    part = read(spark, sf_dir, "part").withColumns({"path": F.when(F.col("p_size") >= 20, "x.pdf"), "error": F.when(F.col("p_size") < 10, "status 500"), "scanned": (F.col("p_size") >= 20) & (F.col("p_size") < 30)})
    return part.select(F.col("p_partkey").alias("id"), search.acquisition_status(F.col("path"), F.col("error"), F.col("scanned"), F.lit(False)).alias("status"))
