"""Host-level quality rules: failures of each rule are summed by domain, the rates shrunk by an empirical beta prior, verdicts joined back.

The prior of a rule has the mean of all documents and the spread of the domains' rates beyond what chance gives them, each domain
weighted by its documents. A domain is rejected, with all its documents, if for any rule its failure rate lies, with CONFIDENCE standard
deviations of its beta posterior to spare, over both FACTOR times the rate of all documents (or half way from it to 1, if that is less, so
that the limit can be reached) and LEAST_RATE: small domains are spared by the prior, large bad ones are not. A domain that holds most documents sets the rate itself and is not rejected for it.

Null texts have no words; a null domain is a domain of its own; repeated rows count and come back as often as they are there; an empty
table gives no rows; ids may be null; texts are measured whole; columns but doc_id, text and the domain are not read.
"""

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches, settled

WINDOW, LEAST_WORDS, MOST_REPEATED, MOST_SYMBOLS, MOST_LINES = 5, 10, 20, 10, 30
#: What a domain's rate must exceed, and by how many standard deviations; most domains in a broadcast (more are joined by salted keys).
FACTOR, LEAST_RATE, CONFIDENCE, BROADCAST_HOSTS, SALTS = 3.0, 0.2, 2.0, 50_000, 64
RULES = ("base", "symbols", "lines")
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURED = [c.split()[0] for c in COUNTS.split(", ")]


def lines_of(text: str | None) -> list[str]:
    """The lines of a text that have a word."""
    return [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")] if isinstance(text, str) else []


def measure(text: str | None, lines: list[str] | None = None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text; its lines_of may be given."""
    import numpy as np

    if not isinstance(text, str):
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # at \x20 and \x09-\x0D
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = lines_of(text) if lines is None else lines
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeated = 0
    if n > WINDOW and len(number) < n:
        code, size = ids[: n - WINDOW + 1].copy(), len(number)
        for k in range(1, WINDOW):
            if size * len(number) >= 1 << 62:
                kinds, code = np.unique(code, return_inverse=True)
                size = len(kinds)
            code = code * len(number) + ids[k : n - WINDOW + 1 + k]
            size *= len(number)
        _, where, counts = np.unique(code, return_inverse=True, return_counts=True)
        twice = counts[where] > 1
        if twice.any():
            edge = np.zeros(n + 1, np.int64)
            at = np.flatnonzero(twice)
            edge[at] += 1
            edge[at + WINDOW] -= 1
            repeated = int((np.cumsum(edge)[:-1] > 0).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def measured(docs: DataFrame, domain: str = "source") -> DataFrame:
    """doc_id, domain, the five counts, n_lines (with a word), and a failure flag for each rule."""

    schema = f"doc_id long, domain string, {COUNTS}, n_lines long"

    def rows(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [(*measure(t, lines := lines_of(t)), len(lines)) for t in texts]
            yield arrow_rows(counts, schema, doc_id=batch.column("doc_id"), domain=batch.column("domain"))

    out = in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(domain).cast("string").alias("domain"), "text"), rows, schema)
    return out.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        "symbols_failed": 100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"),
        "lines_failed": 100 * F.col("n_dup_lines") > MOST_LINES * F.col("n_lines"),
    })


def host_verdicts(rows: DataFrame, factor: float = FACTOR, least_rate: float = LEAST_RATE, confidence: float = CONFIDENCE) -> DataFrame:
    """domain, n, a shrunk rate for each rule, and host_kept."""
    hosts = rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"{r}_failed").cast("long")).alias(r) for r in RULES])
    n = F.col("n")
    total = hosts.agg(F.sum("n").alias("n"), F.count("n").alias("hosts"), F.sum(n * n).alias("n2"), *[F.sum(r).alias(r) for r in RULES]).first()
    mean = {r: (total[r] or 0) / (total["n"] or 1) for r in RULES}
    spread = hosts.agg(*[F.sum(n * (F.col(r) / n - mean[r]) ** 2).alias(r) for r in RULES]).first()
    columns, limits = {}, []
    for r in RULES:
        m = mean[r]
        strength = prior_strength(m, spread[r] or 0.0, total["n"] or 0, total["hosts"], total["n2"] or 0)
        rate = (F.col(r) + m * strength) / (n + strength)
        columns[f"{r}_rate"] = rate
        limits.append(rate - confidence * F.sqrt(rate * (1 - rate) / (n + strength + 1)) > max(min(factor * m, (1 + m) / 2), least_rate))
    out = hosts.withColumns(columns)
    return out.withColumn("host_kept", ~(limits[0] | limits[1] | limits[2])).select("domain", "n", *columns, "host_kept")


def prior_strength(mean: float, spread: float, n: int, hosts: int, n2: int) -> float:
    """The prior's weight in documents, 1 to a million: spread is the sum over hosts of n * (rate - mean)^2, n2 that of n^2.

    Under a beta prior of this weight w, the expected spread is m(1-m) * ((hosts - 1) + (n - n2/n - hosts + 1) / (w + 1)).
    """
    variance, free = mean * (1 - mean), n - n2 / n - hosts + 1 if n else 0
    if variance <= 0 or free <= 0:
        return 1e6 if variance <= 0 else 1.0
    excess = spread / variance - (hosts - 1)
    return min(max(free / excess - 1, 1.0), 1e6) if excess > 0 else 1e6


def judge(docs: DataFrame, domain: str = "source", **limits: float) -> DataFrame:
    """doc_id, the counts, base_failed, host_kept and kept of every row of docs(doc_id, text, domain)."""
    rows = settled(measured(docs, domain), "hostrules")
    hosts = settled(host_verdicts(rows, **limits).select("domain", "host_kept"), "hosts")
    same = F.col("domain").eqNullSafe(F.col("host"))
    if hosts.count() <= BROADCAST_HOSTS:
        joined = rows.join(F.broadcast(hosts.withColumnRenamed("domain", "host")), same)
    else:
        spread = hosts.withColumnRenamed("domain", "host").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("at", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
        joined = rows.join(spread, same & (F.col("at") == F.col("salt")))
    return joined.select("doc_id", *MEASURED, "base_failed", "host_kept", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))
