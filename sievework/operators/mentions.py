"""Which of many names stand in which texts: one automaton over all names, one pass over each text.

A name is found in any case where a word begins, and is open at its end; "Genus epithet" also in its short form ("G. epithet"), if the
second word is a true epithet. Up to NAMES_AT_ONCE names go to every task, which keeps the automaton for its process; more are dealt into
parts of that size, and texts and parts meet by a shuffle, so that no task and not the driver holds them all. Null and empty texts and
names have no hits; repeated names count once; each row of texts has its own hits.
"""

import re
import unicodedata
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Names that a task holds at most, and the tasks that share a part's texts where there are more.
NAMES_AT_ONCE, SALTS = 100_000, 64
#: Second words that are no epithets (fixed values).
NO_EPITHET = {"cf", "aff", "sp", "spp"}
HIT = "name string, at int, whole_at int, begins boolean"
BATCH_ROWS = 512


def _lower(text: str) -> str:
    """Lower case, as long as the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_" or unicodedata.category(c)[0] == "M"


class Names:
    """An automaton over the names, and over the epithets of those that have a short form."""

    def __init__(self, names: Iterable[str], anywhere: bool = False):
        import ahocorasick

        self.names, self.anywhere = sorted(set(names)), anywhere
        found: dict[str, list[tuple[int, str]]] = {}
        for n, name in enumerate(self.names):
            found.setdefault(_lower(name), []).append((n, ""))
            w = name.split(" ")
            if not anywhere and len(w) >= 2 and re.fullmatch("[a-z-]{3,}", w[1]) and w[1] not in NO_EPITHET and w[0]:
                found.setdefault(w[1], []).append((n, _lower(w[0][0])))
        self.longest = max(map(len, found), default=0)
        self.automaton = ahocorasick.Automaton()
        for key, entries in found.items():
            self.automaton.add_word(key, (len(key), entries))
        if found:
            self.automaton.make_automaton()

    def _hits(self, low: str) -> Iterator[tuple[int, int, int]]:
        """(name, start, end) of every place where a name, or its short form, stands at the beginning of a word."""
        for last, (length, entries) in self.automaton.iter(low) if self.longest else ():
            for n, initial in entries:
                start = last - length + 1
                if initial:
                    at = start
                    while at and low[at - 1].isspace():
                        at -= 1
                    if at == start:
                        continue
                    at -= at > 0 and low[at - 1] == "."
                    start = at - 1
                    if start < 0 or low[start] != initial:
                        continue
                if self.anywhere or _in_word(low[start]) != (start > 0 and _in_word(low[start - 1])):
                    yield n, start, last + 1

    def search(self, text: str | None) -> dict[int, list]:
        """For each name found: its first place (from 1), its first place as a whole word, and whether the text, its white space squeezed,
        begins with it and then no letter. A place is None if only that last is so."""
        out: dict[int, list] = {}
        if not text:
            return out
        low = _lower(text)
        for n, start, end in self._hits(low):
            known = out.setdefault(n, [start + 1, None, False])
            known[0] = min(known[0], start + 1)
            if end == len(low) or _in_word(low[end - 1]) != _in_word(low[end]):
                known[1] = min(known[1] or start + 1, start + 1)
        if not self.anywhere:
            head = " ".join(low.split(None, self.longest + 2)[: self.longest + 2])[: 2 * self.longest + 8]
            for n, start, end in self._hits(head):
                if start == 0 and (end == len(head) or not head[end].isalpha()):
                    out.setdefault(n, [None, None, False])[2] = True
        return out


_built: dict[tuple, Names] = {}


def _names(names: tuple[str, ...], anywhere: bool) -> Names:
    """The automaton of this process; one is kept."""
    key = (names, anywhere)
    if key not in _built:
        _built.clear()
        _built[key] = Names(*key)
    return _built[key]


def _found(automaton: Names, keys, texts: list):
    """A record batch of the keys (an array of structs) and HIT."""
    import pyarrow as pa

    rows, hits = [], []
    for row, text in enumerate(texts):
        for n, hit in sorted(automaton.search(text).items()):
            rows.append(row)
            hits.append((automaton.names[n], *hit))
    name, at, whole, begins = zip(*hits) if hits else ((), (), (), ())
    columns = [keys.take(pa.array(rows, pa.int64())), pa.array(name, pa.string()), pa.array(at, pa.int32()), pa.array(whole, pa.int32()), pa.array(begins, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, names=["key", "name", "at", "whole_at", "begins"])


def mentions(texts: DataFrame, names: DataFrame, keys: list[str], text: str = "text", anywhere: bool = False, most: int = NAMES_AT_ONCE) -> DataFrame:
    """keys of texts, name, at, whole_at and begins for each text and name (of names.name) that stands in it. anywhere: also inside words,
    and without short forms; begins is then false."""
    listed = names.select("name").where("name <> ''").distinct()
    few = [r.name for r in listed.limit(most + 1).collect()]
    source = texts.select(F.struct(*keys).alias("key"), F.col(text).cast("string").alias("text"))
    schema = StructType([source.schema["key"], *StructType.fromDDL(HIT).fields])
    if len(few) <= most:
        known = tuple(sorted(few))

        def searched(batches: Iterator) -> Iterator:
            automaton = _names(known, anywhere)
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    part = batch.slice(at, BATCH_ROWS)
                    yield _found(automaton, part.column("key"), part.column("text").to_pylist())

        out = source.mapInArrow(searched, schema)
    else:
        parts = -(-listed.count() // (most * 3 // 4 or 1))  # hashed parts are not quite equal
        every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        dealt = listed.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = dealt.select("part", "salt", F.lit(0).alias("kind"), F.lit(None).cast(source.schema["key"].dataType).alias("key"), F.col("name").alias("text"))
        salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
        both = source.where("text <> ''").select(every.alias("part"), salt.alias("salt"), F.lit(1).alias("kind"), "key", "text").unionByName(dealt)
        out = both.repartition("part", "salt").sortWithinPartitions("part", "salt", "kind").mapInArrow(lambda batches: _parts(batches, anywhere), schema)
    return out.select("key.*", "name", "at", "whole_at", "begins")


def _parts(batches: Iterator, anywhere: bool) -> Iterator:
    """Hits of batches sorted by part, salt and kind: the names of a part come before its texts."""
    import numpy as np

    names, at, automaton = [], None, None
    for batch in batches:
        groups = np.stack([batch.column(c).to_numpy() for c in ("part", "salt", "kind")])
        cuts = [0, *(np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            part, salt, kind = groups[:, lo].tolist()
            if at != (part, salt):
                names, at, automaton = [], (part, salt), None
            piece = batch.slice(lo, hi - lo)
            if kind == 0:
                names += piece.column("text").to_pylist()
                continue
            automaton = automaton or _names(tuple(sorted(names)), anywhere)
            for k in range(0, piece.num_rows, BATCH_ROWS):
                some = piece.slice(k, BATCH_ROWS)
                yield _found(automaton, some.column("key"), some.column("text").to_pylist())
