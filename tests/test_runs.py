import os
import sys
from functools import partial

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sievework.operators import acquisition, agents
from sievework.sources import providers

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks cannot import test modules
TEXT = b"%PDF-1.4 " + b"words of text " * 400


def fetch(url, params):
    doi = url.rsplit("/", 1)[-1]
    if doi == "broken":
        raise providers.Unavailable("down")
    return (404, {}) if doi == "closed" else (200, {"best_oa_location": {"url_for_pdf": f"http://f/{doi}"}})


def get(url):
    return {"http://f/good": TEXT, "http://f/scan": b"%PDF-1.4 scan", "http://f/scan2": b"%PDF-1.4 scan2", "http://f/page": b"<html>", "http://mine": TEXT}[url]


def read(content):
    if b"scan2" in content:
        raise ValueError("cannot be read")
    return content.decode()


def ocr(content):
    return TEXT if content.endswith(b"scan") else None


def test_files_are_acquired(spark, tmp_path):
    rows = [("w1", "good", None), ("w2", "closed", None), ("w3", "broken", None), ("w4", "scan", None), ("w5", "scan2", None), ("w6", "page", None), ("w7", "broken", "http://mine"), ("w8", None, None)]
    works = spark.createDataFrame([(*r, None, None, None, "found") for r in rows] + [("w9", "x", None, "old.pdf", False, None, "pdf_ok")], "work_id string, doi string, pdf_url string, path string, ocr boolean, supplement_url string, status string")
    got = acquisition.acquired(works.where("path IS NULL"), f"{tmp_path}/pdf", fetch, get, read, ocr)
    got.write.parquet(f"{tmp_path}/results")
    got = spark.read.parquet(f"{tmp_path}/results")
    status = {r.work_id: r.status for r in got.collect()}
    assert status == {"w1": "pdf_ok", "w2": "no_pdf", "w3": "error", "w4": "pdf_ocr", "w5": "needs_ocr", "w6": "no_pdf", "w7": "pdf_ok", "w8": "no_pdf"}
    assert sorted(os.listdir(f"{tmp_path}/pdf")) == ["w1.pdf", "w4.pdf", "w5.pdf", "w7.pdf"]
    assert open(f"{tmp_path}/pdf/w4.pdf", "rb").read() == TEXT
    after = {r.work_id: (r.status, r.path) for r in acquisition.entered(works, got).collect()}
    assert after["w9"] == ("pdf_ok", "old.pdf") and after["w1"][1].endswith("w1.pdf") and after["w3"] == ("error", None)
    plain = {r.work_id: r.status for r in acquisition.acquired(works.where("path IS NULL"), f"{tmp_path}/pdf", fetch, get).collect()}
    assert plain["w4"] == plain["w5"] == "pdf_ok"


def cheap(prompt):
    if "fail" in prompt:
        raise OSError("400")
    return {"found": True, "value_cat": "round", "evidence": None if "vague" in prompt else "It is round.", "confidence": 0.8}


def strong(prompt, dead=False):
    assert agents.REINFORCED in prompt
    if dead or "dead" in prompt:
        raise OSError("529")
    return {"found": True, "value_cat": "oval", "evidence": "It is oval."}


def test_answers_escalate(spark):
    prompts = spark.createDataFrame([(i, p) for i, p in enumerate(["clear", "vague", "fail", "fail dead", "vague dead"])], "id int, prompt string")
    got = {r.id: (r.value_cat, r.escalated, r.error, r.warning) for r in agents.asked(prompts, cheap, strong).collect()}
    assert got == {0: ("round", False, None, None), 1: ("oval", True, None, None), 2: ("oval", True, None, "OSError: 400"), 3: (None, True, "OSError: 400 | OSError: 529", None), 4: (None, True, "OSError: 529", None)}
    alone = {r.id: (r.value_cat, r.error) for r in agents.asked(prompts, cheap).collect()}
    assert alone[1] == ("round", None) and alone[2] == (None, "OSError: 400")
    with pytest.raises(RuntimeError, match="529"):
        agents.without_errors(agents.asked(prompts, cheap, partial(strong, dead=True)), "run")
    assert agents.without_errors(agents.asked(prompts.where("id < 2"), cheap, strong), "run").count() == 2


def together(prompt):
    if "fail" in prompt:
        raise OSError("400")
    return {"a": {"found": True, "value_cat": "x", "evidence": "A."}, "b": {"found": True, "value_cat": "y", "evidence": None}}


def test_attributes_escalate_each_for_itself(spark):
    singles = F.create_map(F.lit("a"), F.lit("one a"), F.lit("b"), F.lit("one b"), F.lit("c"), F.lit("one c dead"))
    prompts = spark.createDataFrame([("w", "e", "c1", "all"), ("w", "e", "c2", "fail")], "work_id string, entity_id string, chunk_id string, prompt string").withColumn("singles", singles)
    got = {(r.chunk_id, r.attribute_id): (r.value_cat, r.escalated, r.error) for r in agents.asked_together(prompts, together, strong).collect()}
    assert got == {("c1", "a"): ("x", False, None), ("c1", "b"): ("oval", True, None), ("c1", "c"): (None, True, "OSError: 529"), **{("c2", k): (None, False, "OSError: 400") for k in "abc"}}
