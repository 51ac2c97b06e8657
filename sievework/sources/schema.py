"""The store's tables: columns, keys, and how a folder of Parquet tables is opened, whatever columns were added later."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES: dict[str, tuple[str, list[str]]] = {
    "target": ("entity_id string, entity string, genus string, epithet string, family string, status_external string, status_oral string, status_cartilage string, described boolean, list_source string, list_date date", ["entity_id"]),
    "reference": ("entity_id string, character string, author string, year int, title string, journal string, doi string, raw string", []),
    "alias": ("entity_id string, alias string, source string, work_doi string", []),
    "attribute": ("attribute_id string, name string, kind string, unit string, stage string, definition string, accepted string, lowest double, highest double, search_terms string", ["attribute_id"]),
    "pair_state": ("entity_id string, attribute_id string, state string, updated timestamp", ["entity_id", "attribute_id"]),
    "search_log": ("search_id string, entity_id string, source string, language string, query string, at timestamp, n_results int", ["search_id"]),
    "work": ("work_id string, doi string, title string, year int, language string, source string, pdf_url string, supplement_url string, path string, ocr boolean, status string, abstract string, document_type string, page_url string", ["work_id"]),
    "work_entity": ("work_id string, entity_id string, source string", ["work_id", "entity_id"]),
    "triage": ("work_id string, relevant boolean, prob double, why string, decided_by string, at timestamp", ["work_id"]),
    "chunk": ("chunk_id string, work_id string, kind string, section string, page int, language string, text string, ord int", ["chunk_id"]),
    "extraction": (
        "extraction_id string, work_id string, chunk_id string, entity_id string, name_in_article string, attribute_id string, value_num double, value_cat string, unit string, stage string, temperature double, setting string, n int, "
        "dispersion string, page int, evidence string, confidence double, extractor string, model_version string, prompt_version string, origin string, primary_doi string, status string, reason string, at timestamp",
        ["extraction_id"],
    ),
    "work_context": ("work_id string, stage string, temperature double, setting string, n int, dispersion string, evidence string, escalated boolean, at timestamp, basis string", ["work_id"]),
    "review": ("extraction_id string, reviewer string, verdict string, corrected string, remark string, at timestamp", []),
    "gold": ("work_id string, entity_id string, attribute_id string, reviewer string, value string, unit string, evidence string, at timestamp", []),
    "threshold": ("attribute_id string, threshold double, precision double, recall double, n_gold int, decision string, at timestamp", ["attribute_id"]),
    "value_call": ("work_id string, entity_id string, attribute_id string, chunk_id string, escalated boolean, found boolean, at timestamp", []),
    "extraction_cost": ("at timestamp, model string, input double, output double, usd double, pairs int, stopped boolean", []),
    "work_cost": ("work_id string, model string, input double, output double, usd double, seconds double", []),
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table][0])


def shaped(rows: DataFrame, table: str) -> DataFrame:
    """rows with a table's columns in order; missing ones are null, of other types cast; unknown columns are an error."""
    schema = schema_of(table)
    if unknown := set(rows.columns) - set(schema.names):
        raise ValueError(f"{table} has no columns {', '.join(sorted(unknown))}")
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def opened(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of a folder; one that is not there yet is made, empty. Columns that older files lack are null."""
    out = {}
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            spark.createDataFrame([], schema_of(name)).write.parquet(path)
        out[name] = spark.read.schema(schema_of(name)).parquet(path)
    return out


def without_evidence(extractions: DataFrame) -> int:
    """How many rows break the rule that a value has evidence."""
    return extractions.where(F.col("evidence").isNull()).count()
