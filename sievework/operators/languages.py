"""The language of a text by its character trigrams, learned from texts whose language is known.

Trigrams run over letters, words parted by one space, of the first FIRST characters. Each task counts its own texts before counts move.
The model is a bounded table: the KEPT commonest trigrams of each language, with the logarithm of their smoothed share in every language.
A text has the language in which its trigrams are likeliest (the first by name of several), null if it has none that the model knows.
Null languages and empty texts teach nothing; a table without texts gives a model that knows no language.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sievework.sources.tables import settled

FIRST, KEPT, MOST_LANGUAGES, COUNTED = 5000, 4000, 200, 1 << 19


def letters(text: Column | str) -> Column:
    """What trigrams are taken from; a space at either end."""
    t = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.substring(t, 1, FIRST)), r"[^\p{L}]+", " ")), F.lit(" "))


def trigrams(text: str | None) -> list[str]:
    return [text[i : i + 3] for i in range(len(text) - 2)] if text else []


@dataclass
class LanguageModel:
    """languages, and for each trigram that is kept the logarithm of its share in each of them."""

    languages: list[str]
    scores: dict[str, tuple[float, ...]]

    def language(self, text: str | None) -> str | None:
        """Of a text that letters() has prepared."""
        total, known = [0.0] * len(self.languages), False
        get = self.scores.get
        counts: dict[str, int] = {}
        for g in trigrams(text):
            counts[g] = counts.get(g, 0) + 1
        for g, n in sorted(counts.items()):
            if s := get(g):
                known = True
                total = [t + n * x for t, x in zip(total, s)]
        return self.languages[max(range(len(total)), key=lambda i: (total[i], -i))] if known else None


def trigram_counts(docs: DataFrame, language: str = "lang", text: str = "text") -> DataFrame:
    """language, gram and n over docs."""

    def counted(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        held: dict[str, Counter] = {}

        def out():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_pydict({"language": [lang] * len(counts), "gram": list(counts), "n": list(counts.values())})

        for batch in batches:
            for lang, t in zip(batch.column("language").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(trigrams(t))
            if sum(map(len, held.values())) > COUNTED:
                yield from out()
                held = {}
        yield from out()

    source = docs.where(F.col(language).isNotNull() & (F.trim(letters(text)) != "")).select(F.col(language).alias("language"), letters(text).alias("text"))
    return source.mapInArrow(counted, "language string, gram string, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))


def learned(docs: DataFrame, language: str = "lang", text: str = "text", kept: int = KEPT) -> LanguageModel:
    """The model of docs; the driver gets `kept` trigrams of each language, of MOST_LANGUAGES at most."""
    counts = settled(trigram_counts(docs, language, text), "trigrams")
    names = sorted(r.language for r in counts.select("language").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "gram"))
    chosen = counts.withColumn("k", rank).where(F.col("k") <= kept).select("gram").distinct()
    rows = counts.join(chosen, "gram", "left_semi").groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("language", "n"))).alias("n")).collect()
    total = {x: sum(r.n.get(x, 0) for r in rows) + len(rows) for x in names}
    return LanguageModel(names, {r.gram: tuple(math.log((r.n.get(x, 0) + 1) / total[x]) for x in names) for r in rows})


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "language") -> DataFrame:
    """docs with a column for the language of a text; other columns are passed on as they are."""

    def told(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [model.language(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], names=[*batch.schema.names[:-1], name])

    schema = StructType([*docs.schema.fields, StructField(name, StringType())])
    return docs.withColumn("letters_of_text_", letters(text)).mapInArrow(told, schema)


def accuracy(told: DataFrame, truth: str = "lang", guess: str = "language") -> DataFrame:
    """For each true language: texts, those told right, and their share."""
    right = F.count_if(F.col(guess).eqNullSafe(F.col(truth)))
    return told.where(F.col(truth).isNotNull()).groupBy(truth).agg(F.count(F.lit(1)).alias("n"), right.alias("n_right"), (right / F.count(F.lit(1))).alias("share"))

