"""BPE encoding and decoding by a public vocabulary with word ends: a queue of merge ranks over linked symbols."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wayfleet.llm.common import without

#: Pieces a worker remembers, and characters from which a piece is merged anew each time.
KEPT, LONG = 400_000, 64
NAMES = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it shows, else one from U+0100 on, in order."""
    shows = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shows else chr(next(hidden)) for b in range(256)]


class Codec:
    """Encodes and decodes as the vocabulary's own library does, special tokens in a text included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.id: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.string = {i: s for s, i in {**self.id, **self.special}.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {self.id[a] << 20 | self.id[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.id[a + b] for a, b in pairs]
        letters, end = byte_letters(), model["end_of_word_suffix"]
        self.inner, self.last = [self.id[c] for c in letters], [self.id[c + end] for c in letters]
        self.byte_of = {c: b for b, c in enumerate(letters)}
        pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern).findall
        plain = pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9").replace(r"\s", r"\x20\x09-\x0D")
        self.split_ascii = re.compile(plain).findall
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.known: dict[str, tuple[bytes, str]] = {}
        self.same: dict[str, bool] = {}
        self.path, self._library = path, None

    # Text to pieces ---------------------------------------------------------------------------------------

    @property
    def library(self):
        """The library itself, asked only about characters whose properties depend on the version of Unicode."""
        if self._library is None:
            from tokenizers import Tokenizer, normalizers

            self._library = Tokenizer.from_file(self.path)
            compose = normalizers.NFC().normalize_str
            for c in map(chr, range(0x110000)):
                form = unicodedata.decomposition(c)
                if form and form[0] != "<":
                    spread = unicodedata.normalize("NFD", c)
                    if compose(spread) != unicodedata.normalize("NFC", spread):
                        self.same |= dict.fromkeys([c, *spread], False)
            self._compose = compose
        return self._library

    def _agrees(self, c: str) -> bool:
        """Python and the library give this character the same lower case, class and place among marks."""
        library = self.library
        if (known := self.same.get(c)) is not None:
            return known
        marks = (c + "̣́", "́" + c)
        agrees = (
            unicodedata.category(c) != "Cn"
            and library.normalizer.normalize_str(c) == unicodedata.normalize("NFC", regex.sub(r"\s", " ", c)).lower()
            and all(self._compose(m) == unicodedata.normalize("NFC", m) for m in marks)
            and len(library.pre_tokenizer.pre_tokenize_str(f"a{c}a!{c}!")) == len(self.split(f"a{c}a!{c}!"))
        )
        self.same[c] = agrees
        return agrees

    def pieces(self, text: str) -> list[str]:
        """The pieces that are merged by themselves, of a text without special tokens."""
        if text.isascii():
            return self.split_ascii(text.lower())
        letters = set(text)
        if not letters <= self.same.keys():
            for c in letters - self.same.keys():
                self.same[c] = c.isascii() or self._agrees(c)
        if not all(map(self.same.__getitem__, letters)):
            library = self.library
            shown = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
            return [bytes(map(self.byte_of.__getitem__, s)).decode("utf-8") for s, _ in shown]
        # each character is lowered by itself, so a sigma at the end of a word is one like any other
        return self.split(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    # Pieces to ids ----------------------------------------------------------------------------------------

    def merge(self, piece: str) -> list[int]:
        """Token ids of one piece.

        Symbols form a doubly linked list. The queue gives the pair of least rank, of equal ones the leftmost
        (rank and place are one number); an entry whose symbols have been merged with others since is skipped.
        """
        data = piece.encode("utf-8")
        if not data:
            return []
        ids = [*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]]
        n, find, made_of = len(ids), self.rank.get, self.made
        queue = []
        left = ids[0]
        for i in range(1, n):
            right = ids[i]
            rank = find(left << 20 | right)
            if rank is not None:
                queue.append(rank << 32 | i - 1)
            left = right
        if not queue:
            return ids
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if ids[i] < 0 or j < 0 or find(ids[i] << 20 | ids[j]) != rank:
                continue
            made = made_of[rank]
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                rank = find(made << 20 | ids[k])
                if rank is not None:
                    push(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = find(ids[h] << 20 | made)
                if rank is not None:
                    push(queue, rank << 32 | h)
        return [i for i in ids if i >= 0]

    def learn(self, piece: str) -> tuple[bytes, str]:
        """Ids of a piece as little-endian 32-bit numbers, and their strings with spaces between."""
        made = self.merge(piece)
        entry = struct.pack(f"<{len(made)}I", *made), " ".join([self.string[i] for i in made])
        if len(piece) < LONG:
            self.known[piece] = entry
        return entry

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a whole text as little-endian 32-bit numbers, and the text they decode to."""
        if len(self.known) > KEPT:
            self.known.clear()
        if self.parts is None or not any(s in text for s in self.special):
            sections = [text]
        else:
            sections = self.parts(text)
        said: list[bytes] = []
        back: list[str] = []
        find, learn = self.known.get, self.learn
        for section in sections:
            if section in self.special:
                said.append(np.array([self.special[section]], "<u4").tobytes())
                back.append(section)
                continue
            for piece in self.pieces(section):
                a, b = find(piece) or learn(piece)
                said.append(a)
                back.append(b)
        return b"".join(said), " ".join(back)

    def decode(self, ids: Iterable[int]) -> str:
        """The strings of the ids with spaces between, as the library joins them without a decoder; unknown ids are left out."""
        return " ".join([s for i in ids if (s := self.string.get(int(i))) is not None])


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, made once in each worker."""
    return Codec(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenize(docs: DataFrame, name: str = "word_bpe_49k.json", ids: bool = True) -> DataFrame:
    """Encode the whole ``text`` of every document and decode it again.

    Adds ``n_tokens``, ``ids_sha256`` (of the ids as little-endian 32-bit numbers), ``decoded_sha256`` (of the decoded
    text in UTF-8) and, with ``ids``, the ids themselves; the text goes. Columns of these names, whatever their case,
    are replaced, other columns stay. Null text is encoded as the empty text, which has no tokens and decodes to
    the empty text; repeated rows get the same result. A worker merges each distinct piece once and remembers at most
    400,000 of less than 64 characters; a piece of any length takes L log L steps.
    """
    docs = without(docs, NAMES)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    types += ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    path = vocabulary(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            kept = [n for n in batch.schema.names if n != "text"]
            counts, said, back, every = [], [], [], []
            for text in batch.column("text").to_pylist():
                packed, decoded = bpe.encode(text or "")
                counts.append(len(packed) // 4)
                said.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if ids:
                    every.append(np.frombuffer(packed, "<i4"))
            made = [pa.array(counts, pa.int64()), pa.array(said, pa.string()), pa.array(back, pa.string())]
            if ids:
                made.append(pa.array(every, pa.list_(pa.int32())))
            columns = [*[batch.column(n) for n in kept], *made]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids])

    return docs.mapInArrow(run, types)


def detokenize(tokens: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """Turn ``ids`` back into ``text``, a column that replaces any of its name; null ids give null."""
    tokens = without(tokens, ["text"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema) + ", text string"
    path = vocabulary(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return tokens.mapInArrow(run, types)
