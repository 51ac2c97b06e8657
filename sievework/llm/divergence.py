"""Audit of sources: how far the word use of each source of a language lies from the others', and the words that set it apart.

Terms are counted by task before they are shuffled. A language keeps the terms in LEAST_DOCUMENTS of its documents or more; p is a term's
smoothed share, in parts of SCALE, in a source or in the whole language, and f(p, q) = floor((p - q)^2 / (p + q)) what a term adds.

Pairs of sources: a term that a source lacks has the source's baseline share, so the sum over all kept terms is that of two sources
without terms, corrected for the terms one of them has (by how many terms have each count: a short list for each source) and for those
that both have. The latter are summed as matrices over BLOCK by BLOCK sources in tasks that hold some of the terms each; pairs of sources
are never formed for single terms. Terms of a source: the first RANKS by radix selection.

Null text, lang and source count as empty; a source without terms, or a language without kept terms, has its rows all the same. Repeated
rows are documents of their own; texts are read whole; doc_id and other columns are not read. An empty table gives no rows.
"""

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, settled
from .radix import first_k

LEAST_DOCUMENTS, SCALE, RANKS = 10, 1_000_000_000, 10
#: Terms that a task counts before it passes them on, sources in a block, and pairs of sources that are valued at once.
COUNTED, BLOCK, PAIRS = 1 << 20, 256, 1 << 20
#: Letters and all that is not ASCII, over UTF-8 bytes (so that only A-Z are lower-cased).
TERM = rb"[a-z\x80-\xff]+"


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n_docs and n of docs(text, lang, source), in several rows to be summed. The term null says that the group occurs."""
    pattern = re.compile(TERM)

    def counted(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        docs_of, n_of, size = {}, {}, 0

        def out():
            for (lang, source), n in n_of.items():
                terms = list(n)
                for at in range(0, len(terms), 1 << 14):
                    part = terms[at : at + (1 << 14)]
                    yield pa.RecordBatch.from_pydict({
                        "lang": [lang] * len(part), "source": [source] * len(part), "term": pa.array([t if t is None else t.decode() for t in part], pa.string()),
                        "n_docs": [docs_of[lang, source][t] for t in part], "n": [n[t] for t in part],
                    })

        for batch in batches:
            for text, *group in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
                n, of_docs = n_of.setdefault(tuple(group), Counter({None: 0})), docs_of.setdefault(tuple(group), Counter({None: 0}))
                found = pattern.findall(text.encode("utf-8").lower())
                size -= len(n)
                n.update(found)
                of_docs.update(set(found))
                size += len(n)
            if size > COUNTED:
                yield from out()
                docs_of, n_of, size = {}, {}, 0
        yield from out()

    whole = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return in_batches(whole, counted, "lang string, source string, term string, n_docs long, n long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """A term's smoothed share; exact for counts far beyond 64 bits of product."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return F.call_function("div", wide, (total + 2 * kept).cast("decimal(20,0)")) + 1


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def both_terms(shares: DataFrame) -> DataFrame:
    """lang, source, other, value: over the terms that two sources both have, f(p, q) - f(p, baseline) - f(baseline, q) + f(baselines).

    shares: lang, source, term, p, base (the source's baseline), blocks (of sources of the language). Each pair comes in one order, in
    several rows to be summed.
    """

    def tiles(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        tile, number, sums = None, {}, None

        def out():
            """The sums of the tile's pairs; within a tile of two blocks, pairs of one block belong to that block's own tile."""
            names = list(number)
            block = np.array([b for b, _ in names])
            n = len(names)
            value = sums[:n, :n] + sums[:n, :n].T
            pairs = np.triu(value != 0, 1)
            if tile[1] != tile[2]:
                pairs &= block[:, None] != block[None, :]
            x, y = np.nonzero(pairs)
            if len(x):
                yield pa.RecordBatch.from_pydict({"lang": [tile[0]] * len(x), "source": [names[k][1] for k in x], "other": [names[k][1] for k in y], "value": value[x, y]})

        def changes(part, columns):
            """The places of a batch at which one of the columns differs from the row before."""
            new = np.zeros(part.num_rows - 1, bool)
            for c in columns:
                new |= pc.not_equal(part.column(c).slice(1), part.column(c).slice(0, part.num_rows - 1)).to_numpy(zero_copy_only=False)
            return np.flatnonzero(new) + 1

        def add(part) -> None:
            """Adds the pairs of a tile's whole terms."""
            nonlocal sums
            named = part.column("source").dictionary_encode()
            block = part.column("block").to_numpy()
            kinds, first, which = np.unique(named.indices.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
            at = np.array([number.setdefault((int(block[i]), named.dictionary[int(k)].as_py()), len(number)) for k, i in zip(kinds, first)], np.int64)[which]
            if sums is None or len(number) > len(sums):
                grown = np.zeros((2 * len(number), 2 * len(number)), np.int64)
                if sums is not None:
                    grown[: len(sums), : len(sums)] = sums
                sums = grown
            p, base = part.column("p").to_numpy(), part.column("base").to_numpy()
            cuts = changes(part, ["term"])
            ends = np.repeat([*cuts, part.num_rows], np.diff([0, *cuts, part.num_rows]))
            count = ends - np.arange(part.num_rows) - 1  # each row meets those after it in its term
            upto = np.cumsum(count)
            lo = 0
            while lo < part.num_rows:
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS)))
                x = np.repeat(np.arange(lo, hi), count[lo:hi])
                y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(np.append(0, count[lo : hi - 1])), count[lo:hi])
                px, py, bx, by = p[x], p[y], base[x], base[y]
                np.add.at(sums, (at[x], at[y]), f(px, py) - f(px, by) - f(bx, py) + f(bx, by))
                lo = hi

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            terms = changes(held, ["lang", "i", "j", "term"]) if held.num_rows > 1 else []
            whole = int(terms[-1]) if len(terms) else 0  # the last term may go on
            ready, held = held.slice(0, whole), held.slice(whole)
            for part, key in _pieces(ready, changes):
                if key != tile:
                    if tile:
                        yield from out()
                    tile, number, sums = key, {}, None
                add(part)
        if held is not None:
            for part, key in _pieces(held, changes):
                if key != tile:
                    if tile:
                        yield from out()
                    tile, number, sums = key, {}, None
                add(part)
        if tile:
            yield from out()

    rows = shares.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "term", "block", "source", "p", "base")
    keys = ["lang", "i", "j", "term"]
    sums = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tiles, "lang string, source string, other string, value long")
    return sums.select("lang", F.least("source", "other").alias("source"), F.greatest("source", "other").alias("other"), "value").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def _pieces(batch, changes):
    """The parts of a batch that lie in one tile, each with the tile."""
    cuts = [0, *(changes(batch, ["lang", "i", "j"]).tolist() if batch.num_rows > 1 else []), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo), tuple(batch.column(c)[lo].as_py() for c in ("lang", "i", "j"))


def audit(docs: DataFrame, ranks: int = RANKS, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank of docs(text, lang, source)."""
    by = Window.partitionBy("lang", "term")
    counts = term_counts(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    counts = counts.withColumns({"of_docs": F.sum("n_docs").over(by), "n_lang": F.sum("n").over(by)}).where(F.col("term").isNull() | (F.col("of_docs") >= least))
    counts = settled(counts.drop("n_docs", "of_docs"), "terms")
    used = counts.where(F.col("term").isNotNull())
    kept = used.select("lang", "term", "n_lang").distinct()
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("all_lang"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("all"))
    groups = counts.where(F.col("term").isNull()).select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("all", "v", "all_lang")})
    base = F.when(F.col("v") > 0, share(F.lit(0), F.col("all"), F.col("v"))).otherwise(F.lit(0))
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    groups = settled(groups.withColumn("base", base).join(sizes, "lang"), "groups")

    p = share(F.col("n"), F.col("all"), F.col("v"))
    shares = settled(used.join(groups, ["lang", "source"]).withColumn("p", p).withColumn("q", share(F.col("n_lang"), F.col("all_lang"), F.col("v"))), "shares")
    apart = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    marks = first_k(apart, ["lang", "source"], "value", "item", ranks)

    # how many terms of a source have each share; then against the baseline of every other source
    steps = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    lists = steps.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("steps"))
    own = groups.join(lists, ["lang", "source"], "left").select("lang", "source", "base", "v", "steps")
    theirs = own.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base"), F.col("steps").alias("other_steps"))
    pairs = own.join(theirs, "lang").where(F.col("source") < F.col("other"))  # each pair of the result, once
    plain = difference(F.col("base"), F.col("other_base"))
    corrected = lambda steps, at: F.aggregate(F.coalesce(steps, F.array().cast("array<struct<p:bigint,m:bigint>>")), F.lit(0).cast("long"), lambda x, y: x + y["m"] * (difference(y["p"], F.col(at)) - plain))
    value = F.when(F.col("v") > 0, F.col("v") * plain + corrected(F.col("steps"), "other_base") + corrected(F.col("other_steps"), "base")).otherwise(F.lit(0).cast("long"))
    sums = pairs.select("lang", "source", "other", value.alias("value")).join(both_terms(shares).withColumnRenamed("value", "more"), ["lang", "source", "other"], "left")
    sums = settled(sums.select("lang", "source", "other", (F.col("value") + F.coalesce("more", F.lit(0))).alias("value")), "pairs")
    both = sums.union(sums.select("lang", "other", "source", "value")).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return ranked.unionByName(marks).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
