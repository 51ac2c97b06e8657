"""Writing of text tables and reports. Small files for people are written by one task; larger results as Parquet by the caller."""

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """One file with a header; a path that exists is an error unless the mode says otherwise."""
    df.coalesce(1).write.options(header=True, sep=sep, quote='"', escape='"').mode(mode).csv(path)


def append_new(df: DataFrame, present: DataFrame, keys: list[str], path: str) -> int:
    """Appends the rows whose keys are not present; gives their number."""
    new = df.join(present.select(*keys), keys, "left_anti").cache()
    n = new.count()
    if n:
        write_csv(new.select(*df.columns), path, mode="append")
    new.unpersist()
    return n


def write_tsv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """Tab separated, nulls as nothing; quoted throughout where cells may hold line breaks."""
    options = {"header": True, "sep": "\t", "nullValue": "", "emptyValue": "", "quoteAll": quote_all, "escape": '"'}
    df.coalesce(1).write.options(**options).csv(path)


def write_for_people(df: DataFrame, path: str, most: int = 100_000) -> int:
    """A ;-separated file with a byte order mark, as spreadsheet programs open it, written by the driver; more rows than `most` are an error."""
    import csv

    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write them as Parquet")
    with open(path, "x", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f, delimiter=";", lineterminator="\n")
        out.writerow(df.columns)
        out.writerows([["" if x is None else x for x in r] for r in rows])
    return len(rows)


def write_text(path: str, text: str) -> None:
    """A file that must not exist yet."""
    with open(path, "x", encoding="utf-8") as f:
        f.write(text)


def write_report(path: str, most: int = 10_000, **parts: DataFrame) -> dict:
    """Small results by name as one JSON document; a part of more rows than `most` is an error, and nothing is written."""
    report = {}
    for name, df in parts.items():
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows; write it as Parquet")
        report[name] = [r.asDict(True) for r in rows]
    with open(path, "w", encoding="utf-8") as f:
        json.dump(report, f, default=str, ensure_ascii=False)
    return report


def copy_files(files: DataFrame, folder: str) -> DataFrame:
    """name and size of files (name, content) written by the tasks that hold them to a shared folder, each by a temporary name first."""

    def write(batches):
        from pyarrow import RecordBatch, fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")
        system.create_dir(base)
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                with system.open_output_stream(f"{base}/{name}.tmp") as f:
                    f.write(content or b"")
                system.move(f"{base}/{name}.tmp", f"{base}/{name}")
            yield RecordBatch.from_pydict({"name": batch.column("name"), "size": [len(c or b"") for c in batch.column("content").to_pylist()]})

    return files.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(write, "name string, size long")
