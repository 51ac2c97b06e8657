"""Token ids as Huffman-shaped wavelet matrices, one compressed, self-contained file for each shard.

The codes of a shard's ids are Huffman codes, dealt so that at each level the ids whose code ends there stand last. A level's bit-plane
is therefore as long as the ids that go on, and the planes together are about as large as the ids' entropy. A file is MAGIC, a header
(ids, documents, symbols, levels, code width), the symbols, their counts and the documents' ids and lengths (deflated), then for each
level the count of zeros, the packed bits and the count of ones before each block of BLOCK bits. access, count and select touch the
planes only where needed; ids() restores all.

Documents stand in ascending id order, null ids first, equal ids by a hash of their texts and then by text; every row is written once.
Null texts are empty (their end id alone); an empty table gives no shards; columns but doc_id and text are not read.
"""

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches, scratch, until_exit
from .tokens import tokenizer

MAGIC, BLOCK, END_ID, SHARD_TOKENS = b"WVMX2\0\0\0", 512, 2, 1 << 22
#: Bytes of the stored input for each write partition.
PART_BYTES, MOST_PARTS = 16 << 20, 20_000
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
INDEX = "part int, shard int, before long, n_tokens long, file string"


def code_lengths(counts) -> list[int]:
    """The Huffman code length of each of some symbols, of which there are counts; 1 for a single symbol."""
    import numpy as np

    order = np.argsort(counts, kind="stable").tolist()
    if len(order) < 2:
        return [1] * len(order)
    weights = [int(counts[i]) for i in order]
    leaves, merged, parent = 0, len(order), [0] * (2 * len(order) - 1)
    for node in range(len(order), 2 * len(order) - 1):  # the two lightest of the leaves and the merged nodes left, both in order of weight
        total = 0
        for _ in range(2):
            if leaves < len(order) and (merged >= node or weights[leaves] <= weights[merged]):
                light, leaves = leaves, leaves + 1
            else:
                light, merged = merged, merged + 1
            parent[light] = node
            total += weights[light]
        weights.append(total)
    depth = [0] * len(parent)
    for node in range(len(parent) - 2, -1, -1):
        depth[node] = depth[parent[node]] + 1
    out = [0] * len(order)
    for k, i in enumerate(order):
        out[i] = depth[k]
    return out


def codes_of(per_length: list[int], width: int):
    """The codes, from the highest of `width` bits on, of symbols in order of length, of which per_length[d] have d + 1 bits."""
    import numpy as np

    kind = np.uint64 if width > 32 else np.uint32
    nodes, out = np.zeros(1, kind), []
    for depth, ending in enumerate(per_length):
        nodes = np.concatenate([nodes, nodes | kind(1 << (width - 1 - depth))])
        out.append(nodes[len(nodes) - ending :])
        nodes = nodes[: len(nodes) - ending]
    return np.concatenate(out) if out else np.zeros(0, kind)


def _deflated(array) -> bytes:
    held = zlib.compress(array.tobytes(), 1)
    return struct.pack("<Q", len(held)) + held


def build(ids, doc_ids: list, ends: list[int]) -> bytes:
    """The file of a shard. ids: unsigned 32-bit array; ends: of each document, the number of ids up to its end."""
    import numpy as np

    ids = np.asarray(ids, np.uint32)
    by_id = np.bincount(ids)
    symbols = np.flatnonzero(by_id)
    counts = by_id[symbols]
    lengths = np.array(code_lengths(counts), np.int64)
    order = np.lexsort((symbols, lengths))
    symbols, counts, lengths = symbols[order], counts[order], lengths[order]
    levels = int(lengths.max(initial=0))
    width = 64 if levels > 32 else 32
    per_length = np.bincount(lengths, minlength=levels + 1)[1:].tolist()
    codes = codes_of(per_length, width)
    table = np.zeros(len(by_id), codes.dtype)
    table[symbols] = codes
    seq = table[ids]
    going_on = (len(ids) - np.cumsum(np.bincount(lengths, counts, levels + 1))).astype(np.int64)
    size = np.diff(np.array([0, *ends], "<i8"))
    out = [MAGIC, struct.pack("<QQQQQ", len(ids), len(doc_ids), len(symbols), levels, width)]
    out += [_deflated(np.array(per_length, "<u4")), _deflated(np.diff(symbols, prepend=0).astype("<i4")), _deflated(counts.astype("<u4"))]
    out += [_deflated(np.array([x is None for x in doc_ids], np.uint8)), _deflated(np.diff(np.array([x or 0 for x in doc_ids], "<i8"), prepend=0)), _deflated(size)]
    for level in range(levels):
        one = (seq & codes.dtype.type(1 << (width - 1 - level))) != 0
        packed = np.packbits(one, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
        zeros = seq[~one]
        out += [struct.pack("<Q", len(zeros)), packed.tobytes(), np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes()]
        seq = np.concatenate([zeros, seq[one]])[: going_on[level + 1]]
    return b"".join(out)


class Shard:
    """Reads a shard's file."""

    def __init__(self, blob: bytes):
        import numpy as np

        if blob[:8] != MAGIC:
            raise ValueError("not a shard file")
        self.n, docs, n_symbols, levels, width = struct.unpack_from("<QQQQQ", blob, 8)
        at = 48

        def inflated(kind):
            nonlocal at
            (size,) = struct.unpack_from("<Q", blob, at)
            at += 8 + size
            return np.frombuffer(zlib.decompress(blob[at - size : at]), kind)

        per_length, symbols, counts = inflated("<u4"), np.cumsum(inflated("<i4"), dtype=np.int64), inflated("<u4").astype(np.int64)
        null, ids, size = inflated(np.uint8), np.cumsum(inflated("<i8")), inflated("<i8")
        self.doc_ids = [None if z else x for z, x in zip(null.tolist(), ids.tolist())]
        self.ends = np.cumsum(size)
        codes, lengths = codes_of(per_length.tolist(), width), np.repeat(np.arange(1, levels + 1), per_length)
        #: Of each level, the ids whose code ends there: symbols and counts, in the order in which they stand last.
        first = np.concatenate([[0], np.cumsum(per_length)]).astype(int)
        self.ending = [(symbols[a:b].astype(np.uint32), counts[a:b]) for a, b in zip(first, first[1:])]
        self.code = {s: (int(c) >> (width - d), d) for s, c, d in zip(symbols.tolist(), codes.tolist(), lengths.tolist())}
        self.planes, n = [], self.n
        for _, held in self.ending:
            (zeros,) = struct.unpack_from("<Q", blob, at)
            words = -(-n // BLOCK) * BLOCK // 8
            plane = np.frombuffer(blob, np.uint8, words, at + 8)
            before = np.frombuffer(blob, "<u4", words * 8 // BLOCK + 1, at + 8 + words)
            at += 8 + words + before.nbytes
            n_next = n - int(held.sum())
            self.planes.append((n, zeros, plane, before, n_next))
            n = n_next

    @staticmethod
    def _ones(plane: tuple, i: int) -> int:
        """Ones of a plane before position i."""
        block = i // BLOCK
        if i % BLOCK == 0:
            return int(plane[3][block])
        word = int.from_bytes(plane[2][block * BLOCK // 8 : (block + 1) * BLOCK // 8].tobytes(), "little")
        return int(plane[3][block]) + (word & ((1 << (i % BLOCK)) - 1)).bit_count()

    def access(self, i: int) -> int:
        """The id at position i."""
        import numpy as np

        if not 0 <= i < self.n:
            raise IndexError(i)
        for plane, (symbols, counts) in zip(self.planes, self.ending):
            ones = self._ones(plane, i)
            i = plane[1] + ones if int(plane[2][i >> 3]) >> (i & 7) & 1 else i - ones
            if i >= plane[4]:
                return int(symbols[np.searchsorted(np.cumsum(counts), i - plane[4], side="right")])
        raise ValueError("damaged shard file")

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        code, length = self.code[token]
        for level in range(length):
            plane = self.planes[level]
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            lo, hi = (plane[1] + a, plane[1] + b) if code >> (length - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often a token stands in positions lo to hi, hi left out."""
        if token not in self.code:
            return 0
        lo, hi = self._range(token, lo, self.n if hi is None else hi)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """The position of a token's occurrence number k, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, 0)[0] + k
        code, length = self.code[token]
        for level in range(length - 1, -1, -1):
            plane = self.planes[level]
            one = code >> (length - 1 - level) & 1
            want = i - plane[1] if one else i
            lo, hi = 0, plane[0] - 1
            while lo < hi:  # the first position with more than `want` such bits up to it
                mid = (lo + hi) // 2
                ones = self._ones(plane, mid + 1)
                lo, hi = (lo, mid) if (ones if one else mid + 1 - ones) > want else (mid + 1, hi)
            i = lo
        return i

    def ids(self):
        """All ids, by undoing the stable partitions from the lowest level."""
        import numpy as np

        kind = np.uint16 if max(self.code, default=0) < 1 << 16 else np.uint32
        seq = np.empty(0, kind)
        for (n, zeros, plane, _, _), (symbols, counts) in zip(reversed(self.planes), reversed(self.ending)):
            after = np.concatenate([seq, np.repeat(symbols.astype(kind), counts)])
            one = np.unpackbits(plane, count=n, bitorder="little").view(bool)
            seq = np.empty(n, kind)
            seq[~one] = after[:zeros]
            seq[one] = after[zeros:]
        return seq.astype(np.uint32)


def _files(path: str):
    """The file system of a shared path, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes docs(doc_id, text) in ascending doc_id order: a file for each shard in path/files, and their INDEX as Parquet in path/index.

    A task writes a file under a name of its own attempt first and then moves it, so that a lost or doubled attempt leaves no part of a file.
    """
    end = end_id.to_bytes(4, "little")

    def shards(batches: Iterator) -> Iterator:
        import numpy as np
        from pyspark import TaskContext

        task = TaskContext.get()
        part, tok = task.partitionId(), tokenizer(tokenizer_path)
        system, folder = _files(f"{path}/files")
        number, before, doc_ids, ends, held, n = 0, 0, [], [], [], 0

        def full():
            system.create_dir(folder)
            name = f"{folder}/part-{part:06d}-{number:06d}.wvm"
            with system.open_output_stream(f"{name}.{task.taskAttemptId()}") as f:
                f.write(build(np.frombuffer(b"".join(held), "<u4"), doc_ids, ends))
            system.move(f"{name}.{task.taskAttemptId()}", name)
            return arrow_rows([(part, number, before, n, name.rsplit("/", 1)[-1])], INDEX)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tok.ids(batch.column("text").to_pylist())):
                held += (ids, end)
                n += len(ids) // 4 + 1
                doc_ids.append(doc_id)
                ends.append(n)
                if n >= shard_tokens:
                    yield full()
                    number, before, doc_ids, ends, held, n = number + 1, before + n, [], [], [], 0
        if doc_ids:
            yield full()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, min(size // PART_BYTES, MOST_PARTS)) if size < 1 << 60 else least  # the size of what is no file is not known
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    in_batches(ordered, shards, INDEX).write.parquet(f"{path}/index")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of the shards at path (SCHEMA), its start counted over all shards."""
    index = spark.read.parquet(f"{path}/index")
    base, starts = 0, {}
    for r in sorted(index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):  # as many rows as write partitions
        starts[r.part], base = base, base + r.n

    def documents(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        system, folder = _files(f"{path}/files")
        for batch in batches:
            for r in batch.to_pylist():
                with system.open_input_file(f"{folder}/{r['file']}") as f:
                    shard = Shard(f.read())
                ids, ends = memoryview(shard.ids().astype("<u4").tobytes()), shard.ends
                first = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist())]
                yield arrow_rows([], SCHEMA, doc_id=pa.array(shard.doc_ids, pa.int64()), start=pa.array(first + starts[r["part"]] + r["before"]), n_tokens=pa.array(ends - first), ids_crc32=pa.array(crc, pa.int64()))

    return in_batches(index, documents, SCHEMA)


def token_shards(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Writes the shards to the shared folder and reads them back."""
    path = scratch(docs.sparkSession, "shards")
    write_shards(docs, tokenizer_path, path, end_id)
    until_exit(docs.sparkSession, path)
    return read_shards(docs.sparkSession, path)
