"""Local classifiers of categorical attributes: trained one for each attribute on reviewed rows, kept as files, applied by tasks.

A text is a bag of its words and pairs of neighbouring words, hashed to WIDTH places, as logarithms of counts of length one. The classifier
is a softmax over the attribute's classes, fitted by Adam on all rows: bags stand in blocks that executors keep, and in each of EPOCHS rounds
tasks sum what their blocks add to the gradient. Only weights and these sums, WIDTH numbers for each class, pass the driver. Models are
files named by attribute in a folder that all share; a task loads a model when it first meets its attribute and keeps MODELS_HELD of them.

An attribute without a model has class null and probability 0, which sends its texts to the large model; null texts count as empty; null
labels teach nothing; an attribute with one class is not trained, since it tells nothing.
"""

import io
import re
import zlib
from collections import Counter, OrderedDict
from collections.abc import Callable, Iterable, Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.sources.sinks import copy_files
from sievework.sources.tables import held

WIDTH, EPOCHS, RATE, DECAY = 1 << 15, 200, 0.1, 1e-3
MODELS_HELD = 16
#: Places in a block of texts, more if its last text has more; classes, less one for each attribute, that are fitted at once.
BLOCK, COLUMNS = 1 << 17, 32
#: What a text adds to a gradient is rounded to a multiple of this. All that is added is 1 at most, so sums are exact and of one value in any order.
UNIT = 2.0**-50
#: Bits of a text's hash by which a class is counted.
HEAD_BITS = 12
WORD = re.compile(r"\w+")


def counted(text: str | None):
    """(places, counts) of a text's words and pairs of words."""
    import numpy as np

    words = [w.encode() for w in WORD.findall((text or "").lower())]
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    said = [*map(zlib.crc32, words), *map(zlib.crc32, map(b" ".join, zip(words, words[1:])))]
    return np.unique(np.array(said, np.int64) % WIDTH, return_counts=True)


def places(text: str | None):
    """(places, weights) of a text's words and pairs of words."""
    import numpy as np

    at, n = counted(text)
    x = np.log1p(n)
    return at, x / np.sqrt((x * x).sum()) if len(x) else x


def blocks(rows: Iterable, classes: dict[str, list[str]]) -> Iterator:
    """Rows (text, attribute, label) as blocks of bags end to end: places, a level for each and what the levels stand for, and of each text its
    number of places, its length and its class of each attribute (-1 for none). Rows of one text that follow each other share its bag."""
    import numpy as np

    index = {a: (i, {c: k for k, c in enumerate(cs)}) for i, (a, cs) in enumerate(classes.items())}
    bags, said, size, last = [], [], 0, None

    def block():
        at, n = (np.concatenate(z) for z in zip(*bags))
        counts, level = np.unique(n, return_inverse=True)
        return at.astype(np.uint16), level.astype(np.uint16), np.log1p(counts), np.array([len(a) for a, _ in bags]), np.array([np.sqrt((np.log1p(n) ** 2).sum()) for _, n in bags]), np.array(said, np.int32)

    for text, attribute, label in rows:
        i, of = index[attribute]
        if not said or text != last or said[-1][i] >= 0:
            if size >= BLOCK:
                yield block()
                bags, said, size = [], [], 0
            bags.append(counted(text))
            said.append([-1] * len(index))
            size, last = size + len(bags[-1][0]), text
        said[-1][i] = of[label]
    if said:
        yield block()


def pulled(some: Iterable, shares: list, w, b):
    """What blocks add to the gradients of w (columns by places) and b, in UNITs. `shares` has the weight of a text of each class, for each
    attribute; its last class has no column: its weights are taken as 0, those of the others as what they are above its own."""
    import numpy as np

    to_w, to_b = np.zeros(w.shape), np.zeros(b.shape)
    for at, level, levels, sizes, lengths, said in some:
        at, x, full = at.astype(np.intp), levels.take(level), sizes > 0
        starts = (np.cumsum(sizes) - sizes)[full]
        by = np.zeros(len(sizes))
        by[full] = 1 / lengths[full]
        first = 0
        for i, share in enumerate(shares):
            columns = range(first, first := first + len(share) - 1)
            z = np.zeros((len(sizes), len(share)))
            for j, c in enumerate(columns):
                if len(at):
                    z[full, j] = np.add.reduceat(x * w[c].take(at), starts) * by[full]
                z[:, j] += b[c]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            known = np.flatnonzero(said[:, i] >= 0)
            p[known, said[known, i]] -= 1
            weight = np.zeros(len(sizes))
            weight[known] = share[said[known, i]] / UNIT
            for j, c in enumerate(columns):
                error = p[:, j] * weight
                to_w[c] += np.bincount(at, np.rint(x * np.repeat(error * by, sizes)), WIDTH)
                to_b[c] += np.rint(error).sum()
    return to_w, to_b


def fitted_each(counts: dict[str, dict[str, int]], pull: Callable, epochs: int = EPOCHS) -> dict[str, "Softmax"]:
    """A model for each attribute with the counts of its classes; pull(shares, w, b) gives `pulled` of all blocks."""
    import numpy as np

    classes = {a: sorted(n) for a, n in counts.items()}
    shares = [np.array([1 / (len(cs) * counts[a][c]) for c in cs]) for a, cs in classes.items()]  # each class counts alike
    state = [[[np.zeros((len(cs), WIDTH)), np.zeros(len(cs))] for _ in range(3)] for cs in classes.values()]
    for t in range(1, epochs + 1):
        above = [[x[:-1] - x[-1] for x in weights] for weights, _, _ in state]
        pulls = pull(shares, np.concatenate([w for w, _ in above]), np.concatenate([b for _, b in above]))
        first = 0
        for (weights, m, v), share in zip(state, shares):
            one = slice(first, first := first + len(share) - 1)
            for k, (x, d) in enumerate(zip(weights, (g[one] * UNIT for g in pulls))):
                d = np.concatenate([d, -d.sum(0, keepdims=True)]) + (0 if k else DECAY * x)
                m[k] += 0.1 * (d - m[k])
                v[k] += 0.001 * (d * d - v[k])
                x -= RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return {a: Softmax(cs, w.T.astype(np.float32), b) for (a, cs), ((w, b), _, _) in zip(classes.items(), state)}


class Softmax:
    """Classes with weights for each place."""

    def __init__(self, classes: list[str], weights, bias):
        self.classes, self.weights, self.bias = classes, weights, bias

    @staticmethod
    def fitted(texts: list[str], labels: list[str], epochs: int = EPOCHS) -> "Softmax":
        counts = Counter(labels)
        some = list(blocks(((t, "", y) for t, y in zip(texts, labels)), {"": sorted(counts)}))
        return fitted_each({"": counts}, lambda shares, w, b: pulled(some, shares, w, b), epochs)[""]

    def predicted(self, text: str | None) -> tuple[str, float]:
        """The likeliest class (the first by name of several) and its probability."""
        return self.predicted_at(*places(text))

    def predicted_at(self, at, x) -> tuple[str, float]:
        """That of a text with these places."""
        import numpy as np

        z = x @ self.weights[at] + self.bias if len(at) else self.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.classes[k], float(p[k])

    def dumped(self) -> bytes:
        import numpy as np

        out = io.BytesIO()
        used = np.flatnonzero(self.weights.any(1))
        np.savez_compressed(out, classes=np.array(self.classes), used=used, weights=self.weights[used], bias=self.bias)
        return out.getvalue()

    @staticmethod
    def loaded(content: bytes) -> "Softmax":
        import numpy as np

        z = np.load(io.BytesIO(content), allow_pickle=False)
        full = np.zeros((WIDTH, len(z["classes"])), np.float32)
        full[z["used"]] = z["weights"]
        return Softmax([str(c) for c in z["classes"]], full, z["bias"])


def file_name(attribute: str) -> str:
    return f"{re.sub(r'[^A-Za-z0-9_-]', '_', attribute)[:60]}-{zlib.crc32(attribute.encode()):08x}.npz"


def drawn(rows: DataFrame, rows_per_class: int) -> DataFrame:
    """The `rows_per_class` rows (text, attribute_id, label) of each class whose texts have the least hashes, and then come first. `train` reads
    all rows; this is for a caller who asks for fewer.

    Texts are counted by the head of their hash, so that only those up to the head that reaches the number are gathered by class.
    """
    of = ["attribute_id", "label"]
    hashed = rows.select("text", *of).where("attribute_id IS NOT NULL AND label IS NOT NULL").withColumn("hash", F.xxhash64("text")).withColumn("head", F.shiftright("hash", 64 - HEAD_BITS))
    heads = hashed.groupBy(*of, "head").agg(F.count("*").alias("n"))
    before = heads.withColumn("before", F.sum("n").over(Window.partitionBy(*of).orderBy("head")) - F.col("n"))
    last = before.where(F.col("before") < rows_per_class).groupBy(*of).agg(F.max("head").alias("last"))
    near = hashed.join(held(last), of).where("head <= last")
    order = Window.partitionBy(*of).orderBy("hash", "text")
    return near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= rows_per_class).select("text", *of)


def train(rows: DataFrame, folder: str, epochs: int = EPOCHS) -> DataFrame:
    """name and size of a model for each attribute of rows (text, attribute_id, label) with two classes or more, written to a folder.

    All rows are learned from. Attributes are fitted together, up to COLUMNS at once, since each round is a pass over their blocks.
    """
    known = rows.select("text", "attribute_id", "label").where("attribute_id IS NOT NULL AND label IS NOT NULL")
    counts: dict[str, dict[str, int]] = {}
    for r in known.groupBy("attribute_id", "label").count().orderBy("attribute_id", "label").collect():  # a row for each class
        counts.setdefault(r["attribute_id"], {})[r["label"]] = r["count"]
    parts: list[dict] = []
    for a, n in counts.items():
        if len(n) > 1:
            if not parts or sum(len(x) - 1 for x in parts[-1].values()) + len(n) - 1 > COLUMNS:
                parts.append({})
            parts[-1][a] = n
    made = [(file_name(a), bytearray(m.dumped())) for part in parts for a, m in fitted_on(known, part, epochs).items()]
    return copy_files(rows.sparkSession.createDataFrame(made, "name string, content binary"), folder)


def fitted_on(rows: DataFrame, counts: dict[str, dict[str, int]], epochs: int = EPOCHS) -> dict[str, Softmax]:
    """Models of the attributes counted, from all their rows. Blocks are made where the rows are, dealt out evenly and kept by the executors."""
    context = rows.sparkSession.sparkContext
    classes = {a: sorted(n) for a, n in counts.items()}

    def packed(batches: Iterator) -> Iterator:
        import pickle

        import pyarrow as pa

        told = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("text", "attribute_id", "label"))))
        for block in blocks(told, classes):
            yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(block)], pa.binary())})

    def unpacked(row):
        import pickle

        return pickle.loads(row.block)

    some = rows.where(F.col("attribute_id").isin(*classes)).mapInArrow(packed, "block binary")
    kept = some.repartition(context.defaultParallelism).rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK)  # as Python writes it, which it reads fast

    def pull(*given):
        sent = context.broadcast(given)
        sums = kept.mapPartitions(lambda part: [pulled(part, *sent.value)]).collect()  # one for each task
        sent.destroy()
        return [sum(x) for x in zip(*sums)]

    try:
        return fitted_each(counts, pull, epochs)
    finally:
        kept.unpersist()


_held: OrderedDict = OrderedDict()


def model_of(folder: str, attribute: str | None) -> Softmax | None:
    """The model of an attribute, from this process's store of the last MODELS_HELD, or from its file; None if there is none."""
    from pyarrow import fs

    key = (folder, attribute)
    if key in _held:
        _held.move_to_end(key)
        return _held[key]
    found = None
    if attribute is not None:
        import os

        system, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")
        info = system.get_file_info(f"{base}/{file_name(attribute)}")
        if info.type == fs.FileType.File:
            with system.open_input_file(info.path) as f:
                found = Softmax.loaded(f.read())
    _held[key] = found
    while len(_held) > MODELS_HELD:
        _held.popitem(last=False)
    return found


def predict(rows: DataFrame, folder: str) -> DataFrame:
    """rows (text, attribute_id and any others) with class and prob; sort rows by attribute where there are many models."""
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("class string, prob double").fields])

    def told(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for attribute, text in zip(batch.column("attribute_id").to_pylist(), batch.column("text").to_pylist()):
                model = model_of(folder, attribute)
                out.append(model.predicted(text) if model else (None, 0.0))
            names, probs = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(probs, pa.float64())], names=[*batch.schema.names, "class", "prob"])

    return rows.mapInArrow(told, schema)


def predict_each(rows: DataFrame, attributes: list[str], folder: str) -> DataFrame:
    """For each of some attributes, rows (text and any others) without their text, with attribute_id, class and prob. A text goes to Python
    once, and its places are found once for all attributes."""
    others = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType([*others, *StructType.fromDDL("attribute_id string, class string, prob double").fields])

    def told(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            models = [model_of(folder, a) for a in attributes]
            out = []
            for text in batch.column("text").to_pylist():
                bag = places(text)
                out += [m.predicted_at(*bag) if m else (None, 0.0) for m in models]
            names, probs = zip(*out) if out else ((), ())
            again = batch.select([f.name for f in others]).take(pa.array(np.repeat(np.arange(batch.num_rows), len(attributes))))
            told = [pa.array(attributes * batch.num_rows, pa.string()), pa.array(names, pa.string()), pa.array(probs, pa.float64())]
            yield pa.RecordBatch.from_arrays([*again.columns, *told], names=schema.names)

    return rows.mapInArrow(told, schema)
