"""Byte-pair encoding by a deterministic automaton that accepts exactly the correct tokenizations.

Before any merge the automaton has one state with an arc to itself for each byte. Merge number i, of a and b into c, adds a gadget: the
state s after a is copied to s' without the arc b, arcs a now lead to s', and each state with an arc a gets an arc c to where b led
from s. A copy is stored as its parent and the one arc it lost, at time i. An arc t from state p is there if nothing lost since
p's root blocks it: not t itself, nor, up to t's own merge, the left part t came from, and so on down the left parts.
The automaton is deterministic: each prefix of a word is spelled by exactly one path. So one pass over a word's bytes, by a table of the
transitions met so far, gives each byte position its state and the arc that led there; the word's encoding is read back from its end.
Null texts have no ids; an empty table gives no rows; repeated rows give equal rows; ids may be null; very long texts are encoded whole;
columns but doc_id and text are not read.
"""

import hashlib
import json
import string
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, in_batches
from .tokens import LONG, SPACED, WHITE, byte_characters

#: Chunks in the cache of a process (some 400 bytes each).
CACHED = 500_000
#: Bytes by which the next arcs are looked up, transitions in the table of a process, and the state that stands for none.
START, TRANSITIONS, NONE = 4, 1 << 19, -1
ENCODED = "doc_id long, ids binary, decoded string"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: The public split pattern of byte-level BPE files with use_regex; white space as the Unicode property.
PRE_SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


class Automaton:
    """Compiled merges of a byte-level BPE file. encode(text) gives ids; decode(ids) the arcs' labels, as bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        as_byte, vocab = byte_characters(), spec["model"]["vocab"]
        spell = lambda token: bytes(as_byte[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: t.encode() for t, i in self.added.items()}
        self.split_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        single = {vocab[c]: b for c, b in as_byte.items()}
        self.arcs = {bytes([b]): i for i, b in single.items()}
        self.parent, self.lost, self.time = [-1], [-1], [-1]  # of each state
        self.after = dict.fromkeys(single, 0)  # the state that a token leads to
        self.left, self.born = dict.fromkeys(single, -1), dict.fromkeys(single, -1)
        for i, merge in enumerate(spec["model"]["merges"]):
            x, y = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = vocab[x], vocab[y], vocab[x + y]
            if c in self.left:
                raise ValueError(f"two merges give {x + y!r}")
            self._gadget(i, a, b, c)
            self.arcs[spell(x + y)] = c
        self.labels |= {i: s for s, i in self.arcs.items()}
        self.four = {i: i.to_bytes(4, "little") for i in self.labels}
        longer: dict[bytes, set[int]] = {}
        for x in self.arcs:
            if len(x) > START:
                longer.setdefault(x[:START], set()).add(len(x))
        self.longer = {x: sorted(s, reverse=True) for x, s in longer.items()}
        self.options = lru_cache(1 << 17)(self._options)
        self.table: dict[int, int] = {}
        self.lost_at = lru_cache(1 << 15)(self._lost_at)
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    def _gadget(self, i: int, a: int, b: int, c: int) -> None:
        s, to = self.after[a], self.after[b]
        self.parent.append(s)
        self.lost.append(b)
        self.time.append(i)
        self.after[a], self.after[c] = len(self.parent) - 1, to
        self.left[c], self.born[c] = a, i

    def _options(self, start: bytes) -> tuple[tuple[int, int], ...]:
        """(size, arc) of what may be spelled next, longest first; the arc is -1 if it takes more bytes than `start` to tell."""
        short = [(k, self.arcs[start[:k]]) for k in range(len(start), 0, -1) if start[:k] in self.arcs]
        return (*((k, -1) for k in self.longer.get(start, ())), *short)

    def _lost_at(self, state: int) -> dict[int, int]:
        """The arcs that a state and its parents lost, each with the earliest time."""
        out = {}
        while state:
            out[self.lost[state]] = self.time[state]
            state = self.parent[state]
        return out

    def _step(self, state: int, token: int) -> int:
        """The state that an arc leads to, NONE if the state has lost it; entered in the table."""
        lost, until, part = self.lost_at(state), len(self.parent), token
        to = self.after[token]
        while part >= 0:
            if lost.get(part, until + 1) <= until:
                to = NONE
                break
            part, until = self.left[part], self.born[part]
        if len(self.table) >= TRANSITIONS:
            self.table.clear()
        self.table[state << 20 | token] = to
        return to

    def word(self, spelled: bytes) -> list[int]:
        """The ids of a pre-split word."""
        n, arcs, options, table = len(spelled), self.arcs, self.options, self.table.get
        states, came = [NONE] * (n + 1), [0] * (n + 1)
        states[0] = 0
        for at in range(n):
            state, row = states[at], states[at] << 20
            for size, token in options(spelled[at : at + START]):
                end = at + size
                if end > n or states[end] != NONE:
                    continue
                if token < 0 and (token := arcs.get(spelled[at:end])) is None:
                    continue
                if (to := table(row | token)) is None:
                    to = self._step(state, token)
                if to != NONE:
                    states[end], came[end] = to, token
        path, labels = [], self.labels
        while n:
            path.append(came[n])
            n -= len(labels[came[n]])
        path.reverse()
        return path

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, strings of added tokens being these tokens."""
        import numpy as np

        return np.frombuffer(self.encode_bytes(text)[0], "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))

    def _pieces(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids and labels of chunks that are split alike wherever they stand; a word in a chunk is such a chunk itself."""
        found = list(map(self.cache.get, chunks))
        for i, got in enumerate(found):
            if got is None:
                found[i] = self._chunk(chunks[i])
        return found

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        body = chunk.rstrip(string.punctuation)
        if not (body[1:] if body[:1] == " " else body).isalpha():
            words = PRE_SPLIT.findall(chunk)
        else:  # letters, then marks
            words = (body, chunk[len(body) :]) if len(body) < len(chunk) else (chunk,)
        if len(words) == 1:
            ids = self.word(chunk.encode())
            got = b"".join(map(self.four.__getitem__, ids)), self.decode(ids)
        else:
            both = self._pieces(words)
            got = b"".join([x[0] for x in both]), b"".join([x[1] for x in both])
        if len(chunk) <= LONG:
            self.cache[chunk] = got
        return got

    def encode_bytes(self, text: str) -> tuple[bytes, bytes]:
        """The ids as little-endian unsigned 32-bit integers, and the labels of their arcs."""
        out, at = [], 0
        if len(self.cache) > CACHED:
            self.cache.clear()
        marks = list(self.split_added.finditer(text)) if self.split_added else []
        for m in [*marks, None]:
            out += self._pieces(SPACED.findall(text[at : m.start()] if m else text[at:] if at else text))
            if m:
                i = self.added[m.group()]
                out.append((self.four[i], self.labels[i]))
                at = m.end()
        return b"".join([x[0] for x in out]), b"".join([x[1] for x in out])


_loaded: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The process's automaton of a file."""
    if path not in _loaded:
        _loaded[path] = Automaton(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """docs(doc_id, text) as doc_id, ids (binary, unsigned 32-bit little-endian) and decoded (string)."""

    def encode(batches: Iterator) -> Iterator:
        auto = automaton(tokenizer_path)
        for batch in batches:
            both = (auto.encode_bytes(t) if t is not None else (b"", b"") for t in batch.column("text").to_pylist())
            yield arrow_rows([(ids, text.decode("utf-8", "replace")) for ids, text in both], ENCODED, doc_id=batch.column("doc_id"))

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), encode, ENCODED)


def digest_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of encode_documents, taken where the ids are made (SCHEMA)."""

    def digest(batches: Iterator) -> Iterator:
        auto = automaton(tokenizer_path)
        for batch in batches:
            rows = []
            for t in batch.column("text").to_pylist():
                ids, text = auto.encode_bytes(t) if t is not None else (b"", b"")
                text = text.decode("utf-8", "replace").encode()
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))
            yield arrow_rows(rows, SCHEMA, doc_id=batch.column("doc_id"))

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), digest, SCHEMA)
