"""URL verdicts by Bloom filter cascades that are exact over the corpus's own keys.

A url's keys are its host and the domains above it, of no more labels than a rule's host, each with the path cut to each length that a
rule's path has, so a url has a bounded number of keys. Level 0 holds the listed keys; level 1 the keys of the corpus that level 0 wrongly passes; level 2 the listed keys that level 1 wrongly passes; and so on until
none is left. Over these keys membership is exact, and no join is needed. The share that level 0 passes wrongly falls as the corpus
grows, so the collected false positives stay about as many as the rules. Null urls and urls without :// have no keys and are allowed. Rules that clash or lack a path raise an error. Repeated rows get equal
verdicts; an empty table gives no rows; ids may be null; columns but page_id and url are not read.
"""

import math
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches

URL = re.compile(r"(?s)^.*?://([^/?#]*)([^?#]*)")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Expected false positives of level 0 over the corpus.
EXPECTED = 1000
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


class Bloom:
    """A Bloom filter; salt makes the filters of a cascade independent."""

    def __init__(self, keys, rate: float, salt: int):
        n = max(1, len(keys))
        self.salt, self.hashes = salt, max(1, round(-math.log2(rate)))
        self.size = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        bits = bytearray(-(-self.size // 8))
        for k in keys:
            for i in self._at(k):
                bits[i >> 3] |= 1 << (i & 7)
        self.bits = bytes(bits)

    def _at(self, key: str):
        import xxhash

        h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"), seed=self.salt)
        a, b = h & (1 << 64) - 1, h >> 64 | 1
        return ((a + i * b) % self.size for i in range(self.hashes))

    def __contains__(self, key: str) -> bool:
        bits = self.bits
        return all(bits[i >> 3] >> (i & 7) & 1 for i in self._at(key))


class Cascade:
    """Exact membership for the listed keys and for every key of the universe it was built for."""

    def __init__(self, listed: set[str], first: Bloom, passed: set[str]):
        self.levels, inside, outside = [first], set(listed), set(passed) - set(listed)
        while outside:
            level = Bloom(outside, 0.5, len(self.levels))
            self.levels.append(level)
            inside, outside = outside, {k for k in inside if k in level}

    def __contains__(self, key: str) -> bool:
        for depth, level in enumerate(self.levels):
            if key not in level:
                return depth % 2 == 1
        return len(self.levels) % 2 == 1


def parts(url: str | None) -> tuple[str, str]:
    """Host and path."""
    m = URL.match(url) if isinstance(url, str) else None
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def keys(host: str, path: str, lengths: list[int], labels: int) -> list[str]:
    """A url's keys, longest first: of its host's last 1 to `labels` labels, and of the path cut to the lengths."""
    if not host:
        return []
    last = host.rsplit(".", labels)
    last = last if len(last) <= labels else last[1:]
    hosts = [".".join(last[i:]) for i in range(len(last))]
    return sorted({h + path[:n] for h in hosts for n in lengths if n <= len(path)}, key=lambda k: (-len(k), k))


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """host, path, rule and verdict of every url of pages(page_id, url). rules: (allow or block, host/path), a bounded list."""
    listed = {a: {k for b, k in rules if b == a} for a in ("allow", "block")}
    if listed["allow"] & listed["block"] or any("/" not in k or a not in listed for a, k in rules):
        raise ValueError("rules clash or are malformed")
    lengths = sorted({len(k) - k.index("/") for _, k in rules})
    labels = max((k[: k.index("/")].count(".") + 1 for _, k in rules), default=0)
    rate = min(0.01, EXPECTED / max(1, pages.count() * labels * len(lengths)))
    firsts = {a: Bloom(x, rate, 0 if a == "allow" else 1 << 32) for a, x in listed.items()}

    def passing(batches: Iterator) -> Iterator:
        for batch in batches:
            mine = {k for u in batch.column("url").to_pylist() for k in keys(*parts(u), lengths, labels)}
            yield arrow_rows([(a, k) for a, first in firsts.items() for k in mine if k not in listed[a] and k in first], "action string, key string")

    wrong = in_batches(pages.select("url"), passing, "action string, key string").distinct().collect()
    cascades = {a: Cascade(listed[a], firsts[a], {r.key for r in wrong if r.action == a}) for a in listed}

    def verdicts(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = parts(url)
                found = next(((k, a) for k in keys(host, path, lengths, labels) for a, c in cascades.items() if k in c), (None, "allow"))
                rows.append((host, path, *found))
            yield arrow_rows(rows, SCHEMA, page_id=batch.column("page_id"))

    return in_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"), verdicts, SCHEMA)
