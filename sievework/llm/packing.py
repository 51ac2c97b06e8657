"""Bounded-space online best-fit packing of token sequences.

A fixed number of bins is open. Their free spaces are the set bits of one integer, so the fullest bin that still takes a piece is
the lowest set bit at or above the piece's length. When a bin must be opened and none may be, the fullest is closed.
Each input partition packs its own rows, without a shuffle; only its last open bins may stay part-filled.
Null texts are empty (their end id alone); an empty table gives no rows; repeated rows are packed once each; null ids stay null; very
long texts are cut into pieces of the capacity; columns but doc_id and text are not read.
"""

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches
from .tokens import tokenizer

CAPACITY, OPEN_BINS, END_ID = 4096, 512, 1
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class BestFit:
    """place(length) gives (bin number, offset)."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        if capacity < 1 or open_bins < 1:
            raise ValueError("capacity and open_bins must be positive")
        self.capacity, self.open_bins = capacity, open_bins
        self.free_bits = 0
        self.bins: dict[int, list[int]] = {}
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        held = self.bins[free]
        b = held.pop()
        if not held:
            del self.bins[free]
            self.free_bits &= ~(1 << free)
        self.n_open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.capacity:
            raise ValueError(f"length {length} does not fit")
        fits = self.free_bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            b, free = self.n_bins, self.capacity
            self.n_bins += 1
        left = free - length
        if left:
            self.bins.setdefault(left, []).append(b)
            self.free_bits |= 1 << left
            self.n_open += 1
        return b, self.capacity - free


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, end_id: int = END_ID) -> DataFrame:
    """Packs docs(doc_id, text) into sequences of at most capacity tokens; a row for each piece (SCHEMA)."""
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        fit, tok = BestFit(capacity, open_bins), tokenizer(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tok.ids(batch.column("text").to_pylist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * at : 4 * (at + capacity)]
                    b, offset = fit.place(len(part) // 4)
                    rows.append((doc_id, piece, at, len(part) // 4, zlib.crc32(part), base + b, offset))
            yield arrow_rows(rows, SCHEMA)

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), pack, SCHEMA)
