"""Ranking of texts, carry-forward of context, and the passages worth asking a model about."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import is_key_line, name_pattern, squish, words
from sievework.sources.tables import settled

from .segmentation import is_useful_account

K1, B = 1.2, 0.75


def _count(term: str):
    return F.size(F.filter("tokens", lambda x: x == F.lit(term)))


def bm25_topk(docs: DataFrame, terms: list[str], by: str, k: int) -> DataFrame:
    """The k best documents of each group by BM25 (k1 1.2, b 0.75) over all documents; ties to the smaller id.

    Texts are split once: the narrow rows of counts are written to the shared folder and serve the statistics and the scores. Nothing
    but one row of statistics and the ranking's local top-k moves.
    """
    tokens = F.filter(words(F.coalesce("text", F.lit(""))), lambda x: x != "")
    counted = docs.select(by, "doc_id", tokens.alias("tokens")).select(by, "doc_id", F.size("tokens").alias("dl"), *[_count(t).alias(f"tf{i}") for i, t in enumerate(terms)])
    counted = settled(counted, "counts")
    stats = counted.agg(F.count(F.lit(1)).alias("docs"), F.avg("dl").alias("avgdl"), *[F.sum((F.col(f"tf{i}") > 0).cast("int")).alias(f"df{i}") for i in range(len(terms))]).first()
    length = K1 * (1 - B + B * F.col("dl") / F.lit(stats.avgdl))
    score = F.lit(0.0)
    for i in range(len(terms)):
        df, tf = stats[f"df{i}"] or 0, F.col(f"tf{i}")
        score = score + F.when(tf > 0, F.log1p(F.lit((stats.docs - df + 0.5) / (df + 0.5))) * tf * (K1 + 1) / (tf + length)).otherwise(0.0)
    hit = counted.where(reduce(lambda a, b: a | b, [F.col(f"tf{i}") > 0 for i in range(len(terms))]))
    ranked = hit.select(by, "doc_id", F.round(score, 6).alias("score")).withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "doc_id")))
    return ranked.where(F.col("rank") <= k)


def bounded_carry_forward(rows: DataFrame, group: str, order: str, is_text: Column, hit: Column, other: Column, limit: int) -> DataFrame:
    """group, order, hit, other and anchor: the position of the last text row with a hit, on the next `limit` text rows without one.

    A text row that names another entity ends it, unless it is itself a hit. Hits have no anchor. Rows that are no text neither get one
    nor count. Null conditions count as false; `order` is unique in a group.
    """
    flags = {"is_text": is_text, "hit": hit, "other": other}
    out = rows.select(group, order, *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()])
    event = F.when(F.col("is_text") & (F.col("hit") | F.col("other")), 1).otherwise(0)
    out = out.withColumn("segment", F.sum(event).over(Window.partitionBy(group).orderBy(order)))
    segment = Window.partitionBy(group, "segment", "is_text").orderBy(order)
    out = out.withColumns({"place": F.row_number().over(segment) - 1, "start": F.first(F.when(F.col("hit"), F.col(order))).over(segment)})
    return out.select(group, order, "hit", "other", F.when(F.col("is_text") & F.col("place").between(1, limit), F.col("start")).alias("anchor"))


def section_valid(rows: DataFrame, group: list[str], order: str, hit: Column, header: Column) -> DataFrame:
    """rows with valid: a section that names the entity counts from its first row to the first header at or after it."""
    rows = rows.withColumns({"_h": F.coalesce(hit, F.lit(False)), "_b": F.coalesce(header, F.lit(False))})
    whole = Window.partitionBy(*group)
    rows = rows.withColumn("_p", F.min(F.when(F.col("_h"), F.col(order))).over(whole))
    rows = rows.withColumn("_c", F.min(F.when(F.col("_b") & (F.col(order) >= F.col("_p")), F.col(order))).over(whole))
    return rows.withColumn("valid", F.col("_h") & (F.col("_c").isNull() | (F.col(order) < F.col("_c")))).drop("_h", "_b", "_p", "_c")


def bm25_scores(rows: DataFrame, group: list[str], terms: list[str], text: str = "text") -> DataFrame:
    """rows with score: BM25 within each group, whose rows give the counts and the mean length. An empty text has one word.

    The counts stay in one row for each text; the groups' statistics are one small aggregate, joined back on the group.
    """
    terms = list(dict.fromkeys(t for term in terms for t in _words_of(term)))
    tokens = words(F.coalesce(text, F.lit("")))
    counted = rows.withColumn("tokens", tokens).withColumns({"_dl": F.size("tokens"), **{f"_tf{i}": _count(t) for i, t in enumerate(terms)}}).drop("tokens")
    stats = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.avg("_dl").alias("_avg"), *[F.sum((F.col(f"_tf{i}") > 0).cast("int")).alias(f"_df{i}") for i in range(len(terms))])
    joined = counted.join(stats, group)
    length = K1 * (1 - B + B * F.col("_dl") / F.col("_avg"))
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf = F.col(f"_tf{i}")
        score = score + F.log(1 + (F.col("_n") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5)) * tf * (K1 + 1) / (tf + length)
    return joined.withColumn("score", F.round(score, 6)).select(*rows.columns, "score")


def _words_of(term: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+", term.lower())


def top(rows: DataFrame, group: list[str], k: int, tie: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), tie))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def top_with_slot(rows: DataFrame, group: list[str], k: int, tie: str, special: Column) -> DataFrame:
    """The k best of each group; if none of them is special but some row is, the best special row takes the last place."""
    rows = rows.withColumn("_s", F.coalesce(special, F.lit(False)))
    order = Window.partitionBy(*group).orderBy(F.desc("score"), tie)
    mine = Window.partitionBy(*group, "_s").orderBy(F.desc("score"), tie)
    rows = rows.withColumns({"rank": F.row_number().over(order), "_k": F.row_number().over(mine)}).where((F.col("rank") <= k) | (F.col("_s") & (F.col("_k") == 1)))
    has = F.max(((F.col("rank") <= k) & F.col("_s")).cast("int")).over(Window.partitionBy(*group))
    some = F.max(F.col("_s").cast("int")).over(Window.partitionBy(*group))
    rows = rows.withColumns({"_has": has, "_some": some})
    keep = F.when((F.col("_has") == 1) | (F.col("_some") == 0), F.col("rank") <= k).otherwise((F.col("rank") < k) | (F.col("_s") & (F.col("_k") == 1)))
    return rows.where(keep).drop("_s", "_k", "_has", "_some")


def candidates(chunks: DataFrame, names: list[str], others: list[list[str]], terms: list[str], k: int = 4, limit: int = 3) -> DataFrame:
    """The passages of each work (work_id, chunk_id, ord, kind, section, text) worth asking about one entity and attribute.

    Its own useful accounts with a term, if a work has any. Else passages that name the entity, by text or valid section, or that follow
    one that does (anchor), and have a term, which is looked for as it stands; key lines only if there is nothing else; else tables with
    a term. The k best by BM25 over names and terms, one place kept for a table. Works are handled together, each by itself.
    """
    if not (terms := [t.strip() for t in terms if t and t.strip()]):
        raise ValueError("an attribute needs search terms")
    own = lambda ns, c: F.coalesce(F.col(c).rlike("(?i)" + name_pattern(ns)), F.lit(False)) if ns else F.lit(False)
    starts = lambda ns, c: F.coalesce(squish(c).rlike("(?i)^" + name_pattern(ns) + r"(?!\p{L})"), F.lit(False))
    has_term = reduce(lambda a, b: a | b, [F.contains(F.lower("text"), F.lit(t.lower())) for t in terms])
    query = [*names, *terms]
    rows = chunks.withColumns({"_term": F.coalesce(has_term, F.lit(False)), "_account": F.col("kind") == "account"})
    accounts = rows.where(F.col("_account") & starts(names, "section") & F.col("_term") & is_useful_account("text"))
    best = top(bm25_scores(accounts, ["work_id"], query), ["work_id"], k, "chunk_id").withColumn("anchor", F.lit(None).cast("string"))
    rows = rows.where(~F.col("_account")).join(accounts.select("work_id").distinct(), "work_id", "left_anti")
    others = [[n for n in o if n not in names] for o in others]
    every = [*names, *(n for o in others for n in o)]
    before = F.coalesce(F.lag(F.coalesce("section", F.lit(""))).over(Window.partitionBy("work_id").orderBy("ord")), F.lit(""))
    rows = rows.withColumns({"_new": F.coalesce("section", F.lit("")) != before, "_start": starts(every, "text"), "_any": reduce(lambda a, b: a | b, [own(o, "section") for o in others], own(names, "section"))})

    def cited(rows: DataFrame, ns: list[str], name: str) -> DataFrame:
        hit = own(ns, "section")
        out = section_valid(rows, ["work_id"], "ord", hit, F.col("_start") | (F.col("_new") & F.col("_any") & ~hit))
        return out.withColumn(name, own(ns, "text") | F.col("valid")).drop("valid")

    rows = cited(rows, names, "_cite")
    rows = rows.withColumn("_other", F.lit(False))
    for o in others:
        if o:
            rows = cited(rows, o, "_one").withColumn("_other", F.col("_other") | F.col("_one")).drop("_one")
    carried = bounded_carry_forward(rows, "work_id", "ord", F.col("kind") == "text", F.col("_cite"), F.col("_other"), limit).select("work_id", "ord", "anchor")
    texts = rows.select("work_id", F.col("ord").alias("anchor"), F.col("text").alias("_anchor"))
    rows = rows.join(carried, ["work_id", "ord"]).join(texts, ["work_id", "anchor"], "left").withColumn("anchor", F.col("_anchor")).drop("_anchor")
    found = rows.where("_term").withColumns({"_hit": F.col("_cite") | F.col("anchor").isNotNull(), "_key": is_key_line("text")})
    per = Window.partitionBy("work_id")
    found = found.withColumns({"_plain": F.max((F.col("_hit") & ~F.col("_key")).cast("int")).over(per), "_hits": F.max(F.col("_hit").cast("int")).over(per)})
    use = F.when(F.col("_plain") == 1, F.col("_hit") & ~F.col("_key")).when(F.col("_hits") == 1, F.col("_hit")).otherwise(F.col("kind") == "table")
    ranked = top_with_slot(bm25_scores(found.where(use), ["work_id"], query), ["work_id"], k, "chunk_id", F.col("kind") == "table")
    columns = ["work_id", "chunk_id", "kind", "anchor", "score", "rank"]
    return best.select(*columns).unionByName(ranked.select(*columns))
