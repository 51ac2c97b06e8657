"""Asking models about prompts: the cheap one first, the strong one where the sentence is missing, errors never taken for answers.

A chat is a function that the caller injects: it takes a prompt and gives a dict of the answer's fields, or raises. Prompts are asked by
tasks, in a few partitions. A prompt that both models fail on is an error row, which stops a run before anything of it counts
(`without_errors`); a strong answer counts though the cheap call failed, and says so.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import REINFORCED
from .model import VALUE
from .search import provided

Chat = Callable[[str], dict]
FIELDS = [c.split()[0] for c in VALUE.split(", ")]


def _asked(chat: Chat, prompt: str) -> tuple[dict | None, str | None]:
    try:
        return chat(prompt), None
    except Exception as e:  # a chat's client raises errors of its own kinds; each is an answer that failed
        return None, f"{type(e).__name__}: {e}"


def _lacks(answer: dict | None, critical: tuple[str, ...]) -> bool:
    return answer is None or any(answer.get(c) is None for c in critical)


def answer(prompt: str, cheap: Chat, strong: Chat | None, critical: tuple[str, ...] = ("evidence",)) -> dict:
    """The fields of an answer, with escalated, error and warning (what the cheap model failed with, where the strong one answered)."""
    first, failed = _asked(cheap, prompt)
    if strong is None or not _lacks(first, critical):
        return (first or {}) | {"escalated": False, "error": failed, "warning": None}
    second, failed_too = _asked(strong, f"{prompt}\n\n{REINFORCED}")
    if failed_too:
        return {"escalated": True, "error": " | ".join(x for x in (failed, failed_too) if x), "warning": None}
    return (second or {}) | {"escalated": True, "error": None, "warning": failed}


def asked(prompts: DataFrame, cheap: Chat, strong: Chat | None = None, at_once: int = 4) -> DataFrame:
    """prompts (with a column prompt, and any others of plain types) with the fields of model.VALUE, escalated and warning."""
    keys = [c for c in prompts.columns if c != "prompt"]
    schema = ", ".join([*(f"`{c}` {prompts.schema[c].dataType.simpleString()}" for c in keys), VALUE, "escalated boolean", "warning string"])

    def chat(rows: list[dict]) -> list[dict]:
        return [{k: r[k] for k in keys} | {f: a.get(f) for f in (*FIELDS, "escalated", "warning")} for r in rows for a in [answer(r["prompt"], cheap, strong)]]

    return provided(prompts, chat, schema, at_once)


def asked_together(prompts: DataFrame, cheap: Chat, strong: Chat | None = None, at_once: int = 4) -> DataFrame:
    """An answer for each attribute of prompts(work_id, entity_id, chunk_id, prompt, singles: map of attribute to its own prompt).

    The cheap model answers all of a chunk's attributes at once, as a dict by attribute; an attribute that comes back without a sentence is
    asked for alone, of the strong model. A call that fails is an error for each of its attributes.
    """
    keys = ["work_id", "entity_id", "chunk_id"]
    schema = ", ".join([*(f"{c} {prompts.schema[c].dataType.simpleString()}" for c in keys), "attribute_id string", VALUE, "escalated boolean"])

    def chat(rows: list[dict]) -> list[dict]:
        out = []
        for r in rows:
            every, failed = _asked(cheap, r["prompt"])
            singles = dict(r["singles"])
            for attribute, single in sorted(singles.items()):
                found, error, escalated = (every or {}).get(attribute), failed, False
                if not failed and strong is not None and _lacks(found, ("evidence",)):
                    found, error = _asked(strong, f"{single}\n\n{REINFORCED}")
                    escalated = True
                out.append({k: r[k] for k in keys} | {"attribute_id": attribute, "escalated": escalated} | {f: (found or {}).get(f) for f in FIELDS} | {"error": error})
        return out

    return provided(prompts, chat, schema, at_once)


def without_errors(answers: DataFrame, label: str) -> DataFrame:
    """answers (written ones) if none is an error; else an error that shows the first few."""
    if bad := answers.where(F.col("error").isNotNull()).select("error").limit(3).collect():
        raise RuntimeError(f"{label}: {'; '.join(r.error for r in bad)}")
    return answers
