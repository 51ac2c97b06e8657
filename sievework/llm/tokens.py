"""Token ids of whole texts by the tokenizers library, a text's independent chunks kept in a bounded cache.

Both supported files split a text at white space before any merge, so equal chunks have equal ids wherever they stand.
Texts for which that is not plain (special tokens, unusual characters) go to the library whole. A null text is empty.
"""

import codecs
import os
import re
import string

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
#: A word with the space before it, or white space but the space that belongs to the next word.
SPACED = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: What keeps a text from being lower-cased and split by Python as the library does it.
UNUSUAL = re.compile("[^\t\n\r -~\xa1-į]|<\\|")
#: Bytes that each half of the cache of a process may take, what an entry takes beside its chunk and ids, and the longest chunk that is kept.
CACHE_BYTES, ENTRY_BYTES, LONG = 80 << 20, 200, 64
#: The same for byte-level files.
BYTE_CACHE_BYTES = 128 << 20
#: A piece of plain Latin letters, after a space or none: neither file splits it, so that the library's model may be asked for it alone.
LETTERS = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u0148\u014a-\u017e]+")
#: A key of such letters and then ASCII marks: byte-level files split it between the two and nowhere else.
PLAIN = re.compile(f"({LETTERS.pattern})([{re.escape(string.punctuation)}]*)")
#: What splitting at spaces leaves of other white space after a space: that space may belong to more of it.
ASTRAY = re.compile(f"(?! )[{WHITE}]|\\Z")


class Astray(Exception):
    """A text that splitting at spaces does not cut as the library does."""


def key_of(chunk: str) -> str:
    """The name of a chunk in the cache: what follows its space, so that a text split at spaces gives names; of others, a space and the chunk."""
    return chunk[1:] if chunk[0] == " " and not chunk.isspace() else " " + chunk


def chunk_of(key: str) -> str:
    return key[1:] if key[0] == " " else " " + key


def parts(chunk: str) -> tuple[str, ...]:
    """A chunk of letters (after a space or none) and then ASCII marks, which both files split between the two; else the chunk."""
    body = chunk.rstrip(string.punctuation)
    if len(body) < len(chunk) and (body[1:] if body[:1] == " " else body).isalpha():
        return body, chunk[len(body) :]
    return (chunk,)


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordTokenizer(dict):
    """For files that change texts first. ids(texts) gives each text's ids as little-endian unsigned 32-bit integers. As a dict, it holds the ids of chunks met
    lately; when it is full it becomes the old half, from which chunks that are met again come back."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words_only = self.library.normalizer is not None
        self.as_characters = {b: c for c, b in byte_characters().items()}
        self.four = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.held, self.old = 0, {}

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece; of plain letters from the library's model alone, past its splitting and its records of places."""
        if not LETTERS.fullmatch(piece):
            return self._whole(piece)
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.as_characters)
        elif piece[0] == " ":
            piece = "\u0120" + piece[1:]
        four = self.four
        return b"".join([four[t.id] for t in self.model.tokenize(piece)])

    def _whole(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            pieces = parts(chunk)
            ids = self._piece(chunk) if len(pieces) == 1 else b"".join([self[p] for p in pieces])
        if len(chunk) <= LONG:
            if self.held > CACHE_BYTES:
                self.old, self.held = dict(self), 0
                self.clear()
            self[chunk] = ids
            self.held += ENTRY_BYTES + len(ids)
        return ids

    def _chunks(self, text: str) -> list[str] | None:
        if self.words_only:
            return None if UNUSUAL.search(text) else text.lower().split()
        return None if any(s in text for s in self.special) else SPACED.findall(text)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        chunks = (self._chunks(t) if isinstance(t, str) else [] for t in texts)
        return [self._whole(t) if x is None else b"".join(map(self.__getitem__, x)) for t, x in zip(texts, chunks)]


class ByteTokenizer(WordTokenizer):
    """For byte-level files: chunks stand in the cache under key_of, and a text is split at its spaces alone where that gives its chunks."""

    def __init__(self, path: str):
        super().__init__(path)
        self.byte_text = "".join(self.as_characters[b] for b in range(256))

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            plain = PLAIN.fullmatch(key)
            if plain and plain[2]:
                ids = self[plain[1]] + self[" " + plain[2]]
            elif plain:
                text = codecs.charmap_decode(chunk_of(key).encode(), "strict", self.byte_text)[0]
                four = self.four
                ids = b"".join([four[t.id] for t in self.model.tokenize(text)])
            elif ASTRAY.match(key):
                raise Astray
            else:
                chunks = SPACED.findall(chunk_of(key))
                if len(chunks) > 1:
                    return b"".join([self[key_of(c)] for c in chunks])
                ids = self._whole(chunks[0])
        if len(key) <= LONG:
            if self.held > BYTE_CACHE_BYTES:
                self.old, self.held = dict(self), 0
                self.clear()
            self[key] = ids
            self.held += ENTRY_BYTES + len(ids)
        return ids

    def _text(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole(text)
        keys = text.split(" ")
        try:
            if keys[0]:
                keys[0] = " " + keys[0]
                return b"".join(map(self.__getitem__, keys))
            return b"".join(map(self.__getitem__, keys[1:]))
        except Astray:
            return b"".join([self[key_of(c)] for c in SPACED.findall(text)])

    def ids(self, texts: list[str | None]) -> list[bytes]:
        return [self._text(t) if isinstance(t, str) else b"" for t in texts]


def CachedTokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file: by words if it changes texts first, else by bytes."""
    words = WordTokenizer(path)
    return words if words.words_only else ByteTokenizer(path)


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The process's tokenizer of a file."""
    if path not in _loaded:
        _loaded[path] = CachedTokenizer(path)
    return _loaded[path]
