"""Reading of text tables, JSON lists, TEI documents, spreadsheets kept as CSV, and binary files."""

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sievework.functions.text import content_id, squish

QUOTED = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def csv(spark: SparkSession, path: str, sep: str = ",", inferred: bool = True) -> DataFrame:
    """A CSV file with a header; quoted cells may hold line breaks, so a file is read by one task."""
    return spark.read.options(**QUOTED, sep=sep, inferSchema=inferred).csv(path)


def text_csv(spark: SparkSession, path: str, sep: str = ",", comment: str = "#", **typed: str) -> DataFrame:
    """All columns as text, but those given a type; whole lines that begin with the comment mark are left out. What is no such type is null."""
    d = spark.read.options(**QUOTED, sep=sep, comment=comment, inferSchema=False, nullValue="").csv(path)
    return d.withColumns({c: F.col(c).try_cast(kind) for c, kind in typed.items()})


def sniffed_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """text_csv whose separator is the commoner of ; and , in the first line. Missing columns are an error that says what was found."""
    first = spark.read.text(path).first()
    line = first.value if first else ""
    sep = ";" if line.count(";") > line.count(",") else ","
    d = text_csv(spark, path, sep)
    d = d.withColumnRenamed(d.columns[0], d.columns[0].lstrip("\ufeff")) if d.columns else d
    if missing := [c for c in required if c not in d.columns]:
        raise ValueError(f"{path}: columns {', '.join(missing)} are missing; found {', '.join(d.columns)}, separator {sep!r}")
    return d


def tsv(spark: SparkSession, path: str) -> DataFrame:
    return text_csv(spark, path, "\t", comment="\0")


def json_list(spark: SparkSession, path: str, schema: str, needed: str) -> DataFrame:
    """The rows of the list `needed` of a JSON document; a document without it is an error. schema: of one row."""
    d = spark.read.option("multiLine", True).schema(f"{needed} array<struct<{schema}>>").json(path)
    if d.where(F.col(needed).isNull()).limit(1).count():
        raise ValueError(f"{path} has no {needed}")
    return d.select(F.explode(needed).alias("r")).select("r.*")


def sheet(spark: SparkSession, path: str) -> DataFrame:
    """A spreadsheet kept as CSV: text as it stands, untrimmed, with row_no, the row's number in the sheet (the header is 1). A column
    without a name is col_N; rows without any text are left out. One task reads the file, which keeps the order of its rows."""
    import csv as reader
    import io

    head = spark.read.options(multiLine=True, quote='"', escape='"').csv(path).limit(1).collect()
    names = [(x if x and x.strip() else f"col_{i}") for i, x in enumerate(head[0], 1)] if head else []

    def rows(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                found = list(reader.reader(io.StringIO(content.decode("utf-8-sig"), newline="")))
                kept = [(i, *[(x or None) for x in r], *[None] * (len(names) - len(r))) for i, r in enumerate(found[1:], 2) if any(x.strip() for x in r)]
                yield pd.DataFrame([r[: len(names) + 1] for r in kept], columns=["row_no", *names])

    schema = StructType([StructField("row_no", StringType()), *[StructField(n, StringType()) for n in names]])
    d = spark.read.format("binaryFile").load(path).select("content").mapInPandas(lambda b: (p.astype({"row_no": str}) for p in rows(b)), schema)
    return d.withColumn("row_no", F.col("row_no").cast("long"))


TEI = "{http://www.tei-c.org/ns/1.0}"


def tei_chunks(documents: DataFrame, least: int = 40) -> DataFrame:
    """work_id, kind, section, text, ord and chunk_id of TEI documents (work_id, xml): paragraphs with their headings, then tables, then
    captions, of more than `least` characters, in document order. A document without a body is an error."""

    def chunks(batches: Iterator) -> Iterator:
        import xml.etree.ElementTree as ET

        import pandas as pd

        for pdf in batches:
            rows = []
            for work_id, xml in zip(pdf["work_id"], pdf["xml"]):
                body = ET.fromstring(xml).find(f".//{TEI}body")
                if body is None:
                    raise ValueError(f"{work_id}: no body")
                said = lambda e: " ".join("".join(e.itertext()).split())
                found = []
                for n, div in enumerate(body.iter(f"{TEI}div")):
                    head, paragraphs = div.find(f"{TEI}head"), div.findall(f"{TEI}p")
                    title = None if head is None else said(head)
                    found.append(("heading", title, n, len(paragraphs), ""))
                    found += [("text", title, n, len(paragraphs), said(p)) for p in paragraphs]
                for figure in body.iter(f"{TEI}figure"):
                    table, caption = figure.find(f"{TEI}table"), " ".join(said(x) for x in [*figure.findall(f"{TEI}head"), *figure.findall(f"{TEI}figDesc")])
                    if table is not None:
                        found.append(("table", caption[:120], -1, 0, f"{caption} {said(table)}"))
                    elif caption:
                        found.append(("caption", "caption", -1, 0, caption))
                order = {"heading": 0, "text": 0, "table": 1, "caption": 2}
                found.sort(key=lambda r: order[r[0]])
                rows += [(work_id, i, *r) for i, r in enumerate(found)]
            yield pd.DataFrame(rows, columns=["work_id", "place", "kind", "title", "div", "n_paragraphs", "text"])

    from sievework.operators.segmentation import sections_with_main

    rows = documents.select(F.col("work_id").cast("string").alias("work_id"), "xml").mapInPandas(chunks, "work_id string, place long, kind string, title string, div long, n_paragraphs long, text string")
    heads = sections_with_main(rows.where("kind = 'heading'").select("work_id", "div", F.col("place").alias("ord"), "title", "n_paragraphs")).select("work_id", "div", "section")
    out = rows.where((F.col("kind") != "heading") & (F.length("text") > least)).join(heads, ["work_id", "div"], "left")
    out = out.withColumn("section", F.when(F.col("kind") == "text", F.col("section")).otherwise(F.col("title"))).withColumn("chunk_id", content_id("work_id", "text"))
    from pyspark.sql import Window

    first = out.withColumn("_k", F.row_number().over(Window.partitionBy("work_id", "chunk_id").orderBy("place"))).where("_k = 1")
    return first.select("work_id", "kind", "section", squish("text").alias("text"), F.row_number().over(Window.partitionBy("work_id").orderBy("place")).alias("ord"), "chunk_id")


def binary(spark: SparkSession, path: str) -> DataFrame:
    """path and content of the files of a folder."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


@dataclass
class Settings:
    """What a run is set to; unknown names in a mapping are an error."""

    languages: list[str] = field(default_factory=lambda: ["pt", "es", "en"])
    wanted_precision: float = 0.95
    local_model_least: float = 0.60
    gold_share: float = 0.10
    audit_share: float = 0.05
    per_work: int = 4
    spending_limit: float = float("inf")

    @classmethod
    def of(cls, given: dict) -> "Settings":
        if unknown := set(given) - set(cls.__dataclass_fields__):
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**given)
