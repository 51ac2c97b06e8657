"""Files of works, fetched by a run: locate, download, check, read characters from scans, and what became of each work.

All services are functions that the caller injects and that tasks call, in a few partitions so that a service is not asked by more. A
failure of a service is an error of its work, asked again in the next run, and never "no file". Files go to a folder that all share,
each under another name until it is whole; a work that is asked again writes its file over.
"""

import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.sources import providers

from .upsert import update

#: Characters without white space under which a file is a scan.
LEAST_TEXT = 2000
SCHEMA = "work_id string, path string, ocr boolean, supplement_url string, status string, error string"


def status_of(path: str | None, error: str | None, scanned: bool, ocr: bool) -> str:
    if path is None:
        return "error" if error else "no_pdf"
    return "pdf_ocr" if ocr else "needs_ocr" if scanned else "pdf_ok"


def characters(read: Callable[[bytes], str], content: bytes) -> int:
    """Of a file's text without white space; a file that cannot be read has none."""
    try:
        return len("".join(read(content).split()))
    except Exception:  # readers fail in their own ways on broken files; such a file is treated as a scan
        return 0


def acquired(works: DataFrame, folder: str, fetch: providers.Fetch, get: Callable[[str], bytes], read: Callable[[bytes], str] | None = None, ocr: Callable[[bytes], bytes | None] | None = None, at_once: int = 4) -> DataFrame:
    """SCHEMA for works(work_id, doi, pdf_url): the given address goes before the located one.

    Without `read` no file is taken for a scan; without `ocr`, or where it gives null, a scan keeps its file and waits.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")
        system.create_dir(base)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                access = providers.open_access(fetch, r["doi"])
                error = access["error"]
                content = providers.downloaded(get, r["pdf_url"] or access["pdf"])
                scanned = content is not None and read is not None and characters(read, content) < LEAST_TEXT
                better = ocr(content) if scanned and ocr else None
                path = None
                if content is not None:
                    path = f"{base}/{r['work_id']}.pdf"
                    with system.open_output_stream(f"{path}.part") as f:
                        f.write(better or content)
                    system.move(f"{path}.part", path)
                out.append((r["work_id"], path, better is not None, access.get("supplement"), status_of(path, error, scanned, better is not None), error))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["work_id", "path", "ocr", "supplement_url", "status", "error"])

    asked = works.select(F.col("work_id").cast("string").alias("work_id"), "doi", "pdf_url").repartition(at_once)
    return asked.mapInArrow(run, SCHEMA)


def entered(works: DataFrame, results: DataFrame) -> DataFrame:
    """works with what a run found of each: path, ocr, supplement_url and status; other works stay as they are."""
    return update(works, results.select("work_id", "path", "ocr", "supplement_url", "status"), ["work_id"])
