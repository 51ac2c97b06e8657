"""The passages worth asking a model about, for all open pairs of all works in one plan.

As retrieval.candidates, for every (work, entity, attribute) at once. Names and search terms are looked for by one automaton each, one
pass over the texts; after that only rows of ids move: a chunk meets an entity where it names it, or stands up to `limit` text chunks
after one that does, and an attribute where it holds one of its terms. No work is gathered, and nothing is done entity by entity.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import is_key_line, words
from sievework.sources.tables import settled

from .mentions import mentions
from .retrieval import B, K1, top, top_with_slot
from .segmentation import is_useful_account

PAIR = ["work_id", "entity_id", "attribute_id"]


def search_terms(attributes: DataFrame, terms: str = "search_terms") -> DataFrame:
    """attribute_id and term of the search terms, which stand in one text, with semicolons between them."""
    return attributes.select("attribute_id", F.explode(F.split(terms, ";")).alias("term")).select("attribute_id", F.trim("term").alias("term")).where("term <> ''").distinct()


def _named(chunks: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """work_id, chunk_id, name, at and begins: names of a work's entities in a column of its chunks."""
    found = mentions(chunks, names, ["work_id", "chunk_id"], column)
    return found.join(names.select("work_id", "name").distinct(), ["work_id", "name"])


def _valid(hits: DataFrame, headers: DataFrame, by: list[str]) -> DataFrame:
    """The hits (work_id, by, chunk_id, ord) whose section still holds: those before the first header at or after the first of them.

    headers: work_id, chunk_id, ord, begins (heads an account), new (a new section that names an entity); the latter ends a section only
    where it is no hit itself.
    """
    first = hits.groupBy(*by).agg(F.min("ord").alias("from_"))
    own = hits.select(*by, "chunk_id", F.lit(True).alias("mine_"))
    cut = first.join(headers, "work_id").where("ord >= from_").join(own, [*by, "chunk_id"], "left").where(F.col("begins") | (F.col("new") & F.col("mine_").isNull()))
    cut = cut.groupBy(*by).agg(F.min("ord").alias("cut_"))
    return hits.join(cut, by, "left").where("cut_ IS NULL OR ord < cut_").drop("cut_")


def cited(chunks: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunks that name an entity, and those that name another one.

    chunks: work_id, chunk_id, ord, section, text, which are no accounts; names: work_id, entity_id, name. The first gives work_id,
    entity_id, chunk_id; the second work_id, entity_id, other_id, chunk_id for entities that share a name: there the other one counts
    only by names that are not the entity's own. In a work with chunks without ord a section holds wherever it names the entity.
    """
    place = chunks.select("work_id", "chunk_id", "ord", F.coalesce("section", F.lit("")).alias("section"))
    before = F.coalesce(F.lag("section").over(Window.partitionBy("work_id").orderBy("ord")), F.lit(""))
    place = place.withColumns({"fresh": F.col("section") != before, "unordered": F.max(F.col("ord").isNull()).over(Window.partitionBy("work_id"))}).drop("section")
    texts = settled(_named(chunks, names, "text"), "in_texts")
    sections = settled(_named(chunks, names, "section").where("at IS NOT NULL").select("work_id", "chunk_id", "name").join(place, ["work_id", "chunk_id"]), "in_sections")
    heads = texts.where("begins").select("work_id", "chunk_id").distinct().withColumn("begins", F.lit(True))
    fresh = sections.where("fresh").select("work_id", "chunk_id").distinct().withColumn("new", F.lit(True))
    headers = heads.join(fresh, ["work_id", "chunk_id"], "full").join(place.select("work_id", "chunk_id", "ord"), ["work_id", "chunk_id"])
    headers = settled(headers.select("work_id", "chunk_id", "ord", F.coalesce("begins", F.lit(False)).alias("begins"), F.coalesce("new", F.lit(False)).alias("new")), "headers")
    texts = texts.where("at IS NOT NULL").select("work_id", "chunk_id", "name")

    def of(owners: DataFrame, by: list[str]) -> DataFrame:
        hits = sections.join(owners, ["work_id", "name"]).select(*by, "chunk_id", "ord", "unordered").distinct()
        sure = hits.where("unordered").drop("unordered", "ord")
        held = _valid(hits.where("NOT unordered").drop("unordered"), headers, by).drop("ord")
        return texts.join(owners, ["work_id", "name"]).select(*by, "chunk_id").unionByName(sure).unionByName(held).distinct()

    shared = names.select("work_id", "name", "entity_id").join(names.select("work_id", "name", F.col("entity_id").alias("other_id")), ["work_id", "name"]).where("entity_id <> other_id")
    shared = shared.select("work_id", "entity_id", "other_id").distinct()
    others = shared.join(names.withColumnRenamed("entity_id", "other_id"), ["work_id", "other_id"]).join(names, ["work_id", "entity_id", "name"], "left_anti")
    none = shared.select("work_id", "entity_id", "other_id", F.lit(None).cast(chunks.schema["chunk_id"].dataType).alias("chunk_id"))  # so that the sharing itself is known
    return of(names, ["work_id", "entity_id"]), of(others, ["work_id", "entity_id", "other_id"]).unionByName(none)


def inherited(chunks: DataFrame, cites: DataFrame, others: DataFrame, limit: int) -> DataFrame:
    """work_id, entity_id, chunk_id and anchor_id: the text chunks up to `limit` after one that names the entity, until one names it or another."""
    number = F.row_number().over(Window.partitionBy("work_id").orderBy("ord"))
    unordered = chunks.where("ord IS NULL").select("work_id").distinct()
    texts = chunks.where("kind = 'text'").join(unordered, "work_id", "left_anti").select("work_id", "chunk_id", F.col("text").isNotNull().alias("says"), "ord").withColumn("n", number).drop("ord")
    texts = settled(texts, "texts")
    own = cites.join(texts.where("says"), ["work_id", "chunk_id"]).drop("says")  # a chunk without text is no anchor, but ends another's reach
    apart = others.groupBy("work_id", "entity_id").agg(F.collect_set("other_id").alias("apart"))
    kind = f"array<{cites.schema['entity_id'].dataType.simpleString()}>"
    own = own.join(apart, ["work_id", "entity_id"], "left").withColumn("apart", F.coalesce("apart", F.array().cast(kind)))
    later = own.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(limit)))).select("work_id", "entity_id", "apart", F.col("chunk_id").alias("anchor_id"), "step", (F.col("n") + F.col("step")).alias("n"))
    later = later.join(texts.drop("says"), ["work_id", "n"])
    there = cites.groupBy("work_id", "chunk_id").agg(F.collect_set("entity_id").alias("named"))
    more = others.where("chunk_id IS NOT NULL").select("work_id", "entity_id", "chunk_id").distinct().withColumn("more", F.lit(True))
    later = later.join(there, ["work_id", "chunk_id"], "left").join(more, ["work_id", "entity_id", "chunk_id"], "left")
    event = F.col("more").isNotNull() | F.coalesce(F.exists("named", lambda x: ~F.array_contains("apart", x)), F.lit(False))  # itself is not apart
    ends = F.min(F.when(event, F.col("step"))).over(Window.partitionBy("work_id", "entity_id", "anchor_id"))
    return later.withColumn("ends", ends).where("ends IS NULL OR step < ends").select("work_id", "entity_id", "chunk_id", "anchor_id")


def ranked(found: DataFrame, queries: DataFrame, counts: DataFrame) -> DataFrame:
    """found with score: BM25 of each pair's chunks (found: PAIR, chunk_id, n_words) for its query words.

    queries: PAIR and word; counts: chunk_id, word and tf. The pair's own chunks give the document counts and the mean length.
    """
    found = found.withColumns({"docs_": F.count(F.lit(1)).over(Window.partitionBy(*PAIR)), "mean_": F.avg("n_words").over(Window.partitionBy(*PAIR))})
    hits = found.select(*PAIR, "chunk_id").join(queries, PAIR).join(counts, ["work_id", "chunk_id", "word"])
    hits = hits.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy(*PAIR, "word")))
    hits = hits.join(found.select(*PAIR, "chunk_id", "n_words", "docs_", "mean_"), [*PAIR, "chunk_id"])
    length = K1 * (1 - B + B * F.col("n_words") / F.col("mean_"))
    part = F.log(1 + (F.col("docs_") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (K1 + 1) / (F.col("tf") + length)
    scores = hits.groupBy(*PAIR, "chunk_id").agg(F.round(F.sum(part), 6).alias("score"))
    return found.join(scores, [*PAIR, "chunk_id"], "left").withColumn("score", F.coalesce("score", F.lit(0.0))).drop("docs_", "mean_", "n_words")


def candidates_of_pairs(chunks: DataFrame, names: DataFrame, pairs: DataFrame, terms: DataFrame, k: int = 4, limit: int = 3) -> DataFrame:
    """PAIR, chunk_id, kind, anchor (the text that names the entity, where the chunk itself does not), score and rank.

    chunks: work_id, chunk_id, ord, kind, section, text; names: work_id, entity_id, name, of all entities of the works; pairs: PAIR; terms:
    attribute_id, term. An attribute without terms and a pair without passages have no rows. chunk_id names a chunk within its work.
    """
    chunks = settled(chunks.select("work_id", "chunk_id", "ord", "kind", "section", "text"), "chunks")
    names, pairs = settled(names.select("work_id", "entity_id", "name").where("name <> ''").distinct(), "names"), settled(pairs.select(*PAIR).distinct(), "pairs")
    held = mentions(chunks, terms.select(F.lower("term").alias("name")), ["work_id", "chunk_id"], anywhere=True).select("work_id", "chunk_id", F.col("name").alias("term"))
    held = held.join(terms.select("attribute_id", F.lower("term").alias("term")), "term").select("work_id", "chunk_id", "attribute_id").distinct()
    held = settled(held.join(pairs.select("work_id", "attribute_id").distinct(), ["work_id", "attribute_id"]), "held")
    facts = chunks.select("work_id", "chunk_id", "kind", F.size(words(F.coalesce("text", F.lit("")))).alias("n_words"), is_key_line(F.coalesce("text", F.lit(""))).alias("is_key"))
    facts = settled(facts, "facts")

    heads = mentions(chunks.where("kind = 'account'").where(is_useful_account("text")), names, ["work_id", "chunk_id"], "section").where("begins")
    accounts = heads.join(names, ["work_id", "name"]).select("work_id", "entity_id", "chunk_id").distinct().join(held, ["work_id", "chunk_id"]).join(pairs, PAIR)
    accounts = settled(accounts.join(facts, ["work_id", "chunk_id"]), "accounts")

    rest = chunks.where("kind <> 'account' OR kind IS NULL")
    cites, others = (settled(x, n) for x, n in zip(cited(rest, names), ("cites", "others")))
    carried = inherited(rest, cites, others, limit).join(cites, ["work_id", "entity_id", "chunk_id"], "left_anti")
    met = settled(cites.withColumn("anchor_id", F.lit(None).cast(chunks.schema["chunk_id"].dataType)).unionByName(carried), "met")
    open_pairs = pairs.join(accounts.select(*PAIR).distinct(), PAIR, "left_anti")
    found = met.join(open_pairs, ["work_id", "entity_id"]).join(held, ["work_id", "chunk_id", "attribute_id"]).join(facts, ["work_id", "chunk_id"])
    plain = F.max((~F.col("is_key")).cast("int")).over(Window.partitionBy(*PAIR))
    found = settled(found.withColumn("plain", plain).where("plain = 0 OR NOT is_key").drop("plain"), "found")
    tables = facts.where("kind = 'table'").join(held, ["work_id", "chunk_id"]).join(open_pairs.join(found.select(*PAIR).distinct(), PAIR, "left_anti"), ["work_id", "attribute_id"])
    found = found.unionByName(tables.withColumn("anchor_id", F.lit(None).cast(chunks.schema["chunk_id"].dataType)).select(*found.columns))

    # words that some query asks for, counted in the chunks that are left
    of_names = pairs.join(names, ["work_id", "entity_id"]).select(*PAIR, F.col("name").alias("said"))
    of_terms = pairs.join(terms, "attribute_id").select(*PAIR, F.col("term").alias("said"))
    queries = of_names.union(of_terms).select(*PAIR, F.explode(words("said")).alias("word")).where("word <> ''").distinct()
    every = settled(accounts.withColumn("anchor_id", F.lit(None).cast(chunks.schema["chunk_id"].dataType)).withColumn("own", F.lit(True)).unionByName(found.withColumn("own", F.lit(False))), "every")
    wanted = chunks.join(every.select("work_id", "chunk_id").distinct(), ["work_id", "chunk_id"], "left_semi").select("work_id", "chunk_id", F.explode(words("text")).alias("word"))
    counts = wanted.join(queries.select("work_id", "word").distinct(), ["work_id", "word"], "left_semi").groupBy("work_id", "chunk_id", "word").agg(F.count(F.lit(1)).alias("tf"))
    scored = settled(ranked(every, queries, counts), "scored")
    best = top(scored.where("own"), PAIR, k, "chunk_id")
    rest_best = top_with_slot(scored.where("NOT own"), PAIR, k, "chunk_id", F.col("kind") == "table")
    out = best.select(*PAIR, "chunk_id", "kind", "anchor_id", "score", "rank").unionByName(rest_best.select(*PAIR, "chunk_id", "kind", "anchor_id", "score", "rank"))
    anchors = chunks.select("work_id", F.col("chunk_id").alias("anchor_id"), F.col("text").alias("anchor"))
    return out.join(anchors, ["work_id", "anchor_id"], "left").select(*PAIR, "chunk_id", "kind", "anchor", "score", "rank")
