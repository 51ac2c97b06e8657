"""Extraction of values by a model behind a provider: what is asked, in which parts, and what becomes of the answers."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import content_id, normalized

METHODS, STAGE = "method|metodo|material", r"(?i)\bgosner\b|\bstages?\b|\best[aá]gios?\b"
PER_CALL, MOST_CONTEXT, MOST_ANCHOR, MOST_NAMES = 8, 12_000, 400, 12
#: Characters in a token, the price of a batch against single calls, tokens of an answer.
TOKEN, BATCH_PRICE, ANSWER = 3.5, 0.5, 250


def evidence_holds(evidence: Column | str, text: Column | str) -> Column:
    """Whether the evidence stands in the text, letter for letter but for case and white space; false for none."""
    e, t = (F.col(c) if isinstance(c, str) else c for c in (evidence, text))
    return F.coalesce((e != "") & F.contains(normalized(F.coalesce(t, F.lit(""))), normalized(e)), F.lit(False))


def recorded(answers: DataFrame, chunks: DataFrame, contexts: DataFrame, extractor: str) -> DataFrame:
    """Answers (work_id, chunk_id, entity_id, attribute_id, kind, value_num, value_cat, evidence, confidence) as extractions: raw if the
    evidence stands in the chunk, else rejected; the context is the work's."""
    rows = answers.join(chunks.select("chunk_id", "text"), "chunk_id").join(contexts.select("work_id", "stage"), "work_id", "left")
    ok = evidence_holds("evidence", "text")
    value = {"value_num": F.when(F.col("kind") == "numeric", F.col("value_num")), "value_cat": F.when(F.col("kind") == "categorical", F.col("value_cat"))}
    rows = rows.withColumns({**value, "status": F.when(ok, "raw").otherwise("rejected"), "reason": F.when(~ok, "evidence_not_in_chunk")})
    return rows.withColumn("extraction_id", content_id("work_id", "chunk_id", "entity_id", "attribute_id", F.lit(extractor))).drop("text")


def pending_pairs(chunks: DataFrame, links: DataFrame, pairs: DataFrame, calls: DataFrame) -> DataFrame:
    """work_id, entity_id, attribute_id still to ask: works with chunks, linked entities, open pairs, no call yet."""
    works = chunks.select("work_id").distinct()
    open_ = pairs.where(F.col("state").isin("not_searched", "searched_without_data")).select("entity_id", "attribute_id").distinct()
    return links.select("work_id", "entity_id").distinct().join(works, "work_id", "left_semi").join(open_, "entity_id").join(calls, ["work_id", "entity_id", "attribute_id"], "left_anti")


def context_chunks(chunks: DataFrame) -> DataFrame:
    """The chunks that tell a work's conditions, and why: those of the methods, else text that names a stage."""
    flags = chunks.withColumns({"_m": F.lower(F.coalesce("section", F.lit(""))).rlike(METHODS), "_s": (F.col("kind") == "text") & F.col("text").rlike(STAGE)})
    flags = flags.withColumn("_any", F.max(F.col("_m").cast("int")).over(Window.partitionBy("work_id")))
    out = flags.where("_m OR (_any = 0 AND _s)")
    return out.withColumn("basis", F.when(F.col("_m"), "methods").otherwise("stage")).drop("_m", "_s", "_any")


def context_prompts(chunks: DataFrame) -> DataFrame:
    """One text for each work from its context chunks in order, MOST_CONTEXT characters at most (what the model is given)."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n")
    return context_chunks(chunks).groupBy("work_id").agg(F.substring(joined, 1, MOST_CONTEXT).alias("prompt"), F.min("basis").alias("basis"))


def value_prompt(text: Column, name: Column, rule: Column, entity: Column, names: Column, anchor: Column, kind: Column) -> Column:
    """The text that a model is asked for one attribute: names, the earlier paragraph that names the entity, a hint for tables, the chunk."""
    others = F.array_join(F.slice(F.array_except(names, F.array(entity)), 1, MOST_NAMES), "; ")
    parts = [
        F.concat(F.lit("Entity: "), entity),
        F.when(others != "", F.concat(F.lit("Also named: "), others)),
        F.when(anchor.isNotNull(), F.concat(F.lit("Named in an earlier paragraph: "), F.substring(anchor, 1, MOST_ANCHOR))),
        F.when(kind == "table", F.lit("The passage is a table: use only the row of this entity.")),
        F.concat(F.lit("Attribute: "), name),
        F.when(F.coalesce(rule, F.lit("")) != "", F.concat(F.lit("Rule: "), rule)),
        F.concat(F.lit("Passage:\n"), text),
    ]
    return F.concat_ws("\n", *parts)


def shared_calls(candidates: DataFrame, most: int = PER_CALL) -> DataFrame:
    """work_id, entity_id, chunk_id, call and attributes: a chunk is sent once for up to `most` of the attributes it is a candidate for."""
    place = F.row_number().over(Window.partitionBy("work_id", "entity_id", "chunk_id").orderBy("attribute_id"))
    rows = candidates.select("work_id", "entity_id", "chunk_id", "attribute_id").distinct().withColumn("call", F.floor((place - 1) / most).cast("int"))
    return rows.groupBy("work_id", "entity_id", "chunk_id", "call").agg(F.array_sort(F.collect_list("attribute_id")).alias("attributes"))


def open_vocabularies(attributes: DataFrame) -> DataFrame:
    """Categorical attributes that may not be asked for yet: not closed, without a list, or with a list that goes on elsewhere."""
    bad = (F.col("status") != "closed") | (F.trim(F.coalesce("accepted", F.lit(""))) == "") | F.contains("accepted", F.lit("[+"))
    return attributes.where((F.col("kind") == "categorical") & F.coalesce(bad, F.lit(True))).select("attribute_id", "status")


def escalated(cheap: DataFrame, strong: DataFrame, keys: list[str], critical: list[str]) -> DataFrame:
    """Answers of the cheap model, and of the strong one where a critical field is missing or the call failed; both failed is an error row."""
    need = F.col("c.error").isNotNull()
    for c in critical:
        need = need | F.col(f"c.{c}").isNull()
    columns = [c for c in cheap.columns if c not in keys and c != "error"]
    both = cheap.alias("c").join(strong.alias("s"), keys, "left").withColumn("escalated", need)
    take = [F.when(F.col("escalated"), F.col(f"s.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in columns]
    return both.select(*keys, *take, "escalated", F.when(F.col("escalated"), F.col("s.error")).alias("error"))


def sentence_with(text: Column, word: Column) -> Column:
    """The first sentence that holds a word, in any case; null if none does."""
    found = F.filter(F.split(text, r"(?<=\.)"), lambda s: F.contains(F.lower(s), F.lower(word)) & s.endswith("."))
    return F.get(found, F.lit(0))


def routed(predictions: DataFrame, least: float = 0.6) -> DataFrame:
    """Predictions of a local classifier (kind, class, prob, text) with route: local if sure and a sentence holds the class, else model."""
    sentence = sentence_with(F.col("text"), F.col("class"))
    sure = (F.col("kind") == "categorical") & (F.col("prob") >= least) & sentence.isNotNull()
    local = F.coalesce(sure, F.lit(False))
    return predictions.withColumns({"route": F.when(local, "local").otherwise("model"), "evidence": F.when(local, sentence)})


def batch_cost(prompts: DataFrame, system_length: int, prices: DataFrame) -> DataFrame:
    """usd for each model of prompts (model, prompt) sent as a batch; null for a model without a price. prices: model, input, output."""
    sums = prompts.groupBy("model").agg(F.sum((F.length("prompt") + system_length) / TOKEN).alias("_in"), F.count(F.lit(1)).alias("n"))
    usd = (F.col("_in") * F.col("input") + F.col("n") * ANSWER * F.col("output")) / 1e6 * BATCH_PRICE
    return sums.join(prices, "model", "left").select("model", "n", usd.alias("usd"))


def used_cost(before: DataFrame, after: DataFrame, prices: DataFrame) -> DataFrame:
    """Tokens used between two readings (provider, model, input, output, cached) and their price; null without a price."""
    kinds, keys = ["input", "output", "cached"], ["provider", "model"]
    b = before.select(*keys, *[F.col(k).alias(f"{k}0") for k in kinds])
    d = after.join(b, keys, "full").select(*keys, *[(F.coalesce(F.col(k), F.lit(0)) - F.coalesce(F.col(f"{k}0"), F.lit(0))).alias(k) for k in kinds])
    d = d.where("input > 0 OR output > 0 OR cached > 0").join(prices.select("model", *[F.col(k).alias(f"_{k}") for k in kinds]), "model", "left")
    return d.select(*keys, *kinds, (sum(F.col(k) * F.col(f"_{k}") for k in kinds) / 1e6).alias("usd"))


def checked_batch(results: DataFrame, asked: int, label: str) -> DataFrame:
    """results if there are as many as asked for and each has an answer, else an error, so that nothing is written in part."""
    r = results.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("found").isNull()).alias("bad")).first()
    if r.n != asked:
        raise ValueError(f"{label}: {r.n} answers for {asked} questions")
    if r.bad:
        raise ValueError(f"{label}: {r.bad} of {asked} questions without an answer")
    return results


def extracted_states(pairs: DataFrame, extractions: DataFrame) -> DataFrame:
    """pairs with those set to extracted that have a raw extraction."""
    done = extractions.where("status = 'raw'").select("entity_id", "attribute_id").distinct().withColumn("_d", F.lit(True))
    return pairs.join(done, ["entity_id", "attribute_id"], "left").withColumn("state", F.when(F.col("_d"), "extracted").otherwise(F.col("state"))).drop("_d")
