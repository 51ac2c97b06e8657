"""What a model is asked for and answers: response shapes, prompts for several attributes, contexts still needed, batches under a limit."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .extraction import MOST_ANCHOR, batch_cost, shared_calls

#: The shape of an answer about a value, about the conditions of a work, and about a work's relevance.
VALUE = "found boolean, value_num double, value_cat string, unit string, name_in_article string, evidence string, confidence double, error string"
CONTEXT = "stage string, temperature double, setting string, n int, dispersion string, evidence string, error string"
TRIAGE = "relevant boolean, prob double, why string, error string"
MOST_ABSTRACT = 2500


def value_shapes(attributes: DataFrame) -> DataFrame:
    """attribute_id and the JSON shape of its answer: a number, or one of the accepted values."""
    listed = F.array_join(F.transform(F.split("accepted", ";"), lambda x: F.concat(F.lit('"'), F.trim(x), F.lit('"'))), ", ")
    shape = F.when(F.col("kind") == "numeric", F.lit('{"value_num": "number"}')).otherwise(F.concat(F.lit('{"value_cat": ['), listed, F.lit("]}")))
    return attributes.select("attribute_id", shape.alias("shape"))


def triage_prompt(title: Column, year: Column, doi: Column, abstract: Column) -> Column:
    """What is asked about a work; parts that are not known are left out."""
    parts = [F.concat(F.lit("Title: "), title), F.concat(F.lit("Year: "), year.cast("string")), F.concat(F.lit("DOI: "), doi), F.concat(F.lit("Abstract: "), F.substring(abstract, 1, MOST_ABSTRACT))]
    return F.concat_ws("\n", *parts)


def shared_prompts(candidates: DataFrame, chunks: DataFrame, attributes: DataFrame) -> DataFrame:
    """A prompt for each chunk, entity and call: the chunk once, then each attribute it is asked for with its rule.

    candidates: work_id, entity_id, entity, chunk_id, attribute_id, anchor. attributes is a vocabulary.
    """
    calls = shared_calls(candidates).withColumn("attribute_id", F.explode("attributes"))
    line = F.concat(F.lit("- "), "name", F.when(F.coalesce("rule", F.lit("")) != "", F.concat(F.lit(": "), "rule")).otherwise(""))
    asked = calls.join(attributes.select("attribute_id", line.alias("_line")), "attribute_id")
    lists = asked.groupBy("work_id", "entity_id", "chunk_id", "call").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("attribute_id", "_line"))), lambda x: x["_line"]), "\n").alias("_lines"))
    about = candidates.groupBy("work_id", "entity_id", "chunk_id").agg(F.min("entity").alias("entity"), F.min("anchor").alias("anchor"))
    rows = lists.join(about, ["work_id", "entity_id", "chunk_id"]).join(chunks.select("chunk_id", "text"), "chunk_id")
    prompt = F.concat_ws("\n", F.concat(F.lit("Entity: "), "entity"), F.when(F.col("anchor").isNotNull(), F.concat(F.lit("Named in an earlier paragraph: "), F.substring("anchor", 1, MOST_ANCHOR))), F.lit("Attributes:"), "_lines", F.concat(F.lit("Passage:\n"), "text"))
    return rows.select("work_id", "entity_id", "chunk_id", "call", prompt.alias("prompt"))


def contexts_needed(pending: DataFrame, contexts: DataFrame) -> DataFrame:
    """The works of pending pairs whose conditions have not been asked for yet."""
    return pending.select("work_id").distinct().join(contexts.select("work_id"), "work_id", "left_anti")


def batch_within(prompts: DataFrame, system_length: int, prices: DataFrame, limit: float) -> float:
    """The price of a batch; one over the limit, or for a model without a price, is an error before anything is sent."""
    costs = batch_cost(prompts, system_length, prices).collect()  # a row for each model
    if unknown := [r.model for r in costs if r.usd is None]:
        raise ValueError(f"no price for {', '.join(unknown)}")
    if (total := sum(r.usd for r in costs)) > limit:
        raise ValueError(f"a batch of {total:.2f} is over the limit of {limit:.2f}")
    return total


def second_batch(answers: DataFrame) -> DataFrame:
    """The answers to ask the stronger model for: found, but without evidence."""
    return answers.where(F.col("found") & F.col("evidence").isNull())


def filled_pages(works: DataFrame, found: DataFrame) -> DataFrame:
    """works with the landing page that a service knows for their doi where they have none. found: doi, url."""
    f = found.groupBy(F.lower("doi").alias("_doi")).agg(F.min("url").alias("_url"))
    return works.join(f, F.lower("doi") == F.col("_doi"), "left").withColumn("page_url", F.coalesce("page_url", "_url")).drop("_doi", "_url")
