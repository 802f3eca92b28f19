"""Byte-level BPE encoding and decoding with public rank files, in numpy matrices."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wayfleet.llm.common import without

#: No pair, and the bits of a token id within a pair.
NONE, BITS = np.int32(2**31 - 1), 20
#: Entries of one matrix, bytes from which a piece is merged on a heap, pieces kept by a worker, characters split at once.
CELLS, LONG, KEPT, CHUNK = 1 << 20, 512, 200_000, 1_000_000


class PairTable:
    """Open-addressing table from (left id, right id) to the rank of the merged token."""

    def __init__(self, pairs: dict[int, int]):
        self.shift = 64 - max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 4))))
        self.mask = (1 << (64 - self.shift)) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.ranks = np.full(self.mask + 1, NONE, np.int32)
        for key, rank in pairs.items():
            at = (key * 0x9E3779B97F4A7C15 % 2**64) >> self.shift
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at], self.ranks[at] = key, rank

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where the two make no token or one is padding (negative)."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left.ravel()[todo].astype(np.int64) << BITS) | right.ravel()[todo]
        at = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)
        flat = out.ravel()
        while todo.size:
            there = self.keys[at]
            hit = there == key
            flat[todo[hit]] = self.ranks[at[hit]]
            more = ~hit & (there != -1)
            todo, key, at = todo[more], key[more], (at[more] + 1) & self.mask
        return flat.reshape(left.shape)


class Codec:
    """Encodes and decodes by a rank file, as its vocabulary's reference library does without special tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.token = {i: t for t, i in self.rank.items()}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.rank.items():
            for k in range(1, len(token)):
                left, right = self.rank.get(token[:k]), self.rank.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << BITS | right] = rank
        self.pairs, self.pairs_of = PairTable(pairs), pairs
        self.split = regex.compile(pattern).findall
        self.known: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        """Forget the pieces met so far; a worker that waits for its next task holds the tables only."""
        self.known.clear()
        self.ids: list[np.ndarray] = []
        self.said: list[str] = []
        self.back: list[bytes] = []

    def merge(self, pieces: Sequence[bytes]) -> list[np.ndarray]:
        """Token ids of each piece. Pieces of like length share a padded matrix; in each round every row merges
        its leftmost pair of least rank, the matrix loses a column, and rows without a pair leave it."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            whole = self.rank.get(piece)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif not piece:
                out[i] = np.empty(0, np.int32)
            elif len(piece) > LONG:
                out[i] = self._heap(piece)
            else:
                rest.append(i)
        rest.sort(key=lambda i: len(pieces[i]))
        start = 0
        while start < len(rest):
            shortest = len(pieces[rest[start]])
            end = start
            while end < len(rest) and len(pieces[rest[end]]) <= shortest + shortest // 4 and (end - start + 1) * len(pieces[rest[end]]) <= CELLS:
                end += 1
            end = max(end, start + 1)
            self._rounds([pieces[i] for i in rest[start:end]], rest[start:end], out)
            start = end
        return out

    def _rounds(self, pieces: list[bytes], where: list[int], out: list) -> None:
        length = np.array([len(p) for p in pieces])
        width = int(length.max())
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        tokens = np.where(np.arange(width) < length[:, None], self.byte[flat], np.int32(-1))
        rows, where = np.arange(len(pieces)), np.array(where)
        ranks = np.full(tokens.shape, NONE, np.int32)
        ranks[:, :-1] = self.pairs.find(tokens[:, :-1], tokens[:, 1:])
        while rows.size:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                for r in np.flatnonzero(done):
                    row = tokens[r]
                    out[where[r]] = row[row >= 0]
                keep = ~done
                tokens, ranks, where, at, best, rows = tokens[keep], ranks[keep], where[keep], at[keep], best[keep], rows[keep]
                if not rows.size:
                    return
            n, width = tokens.shape
            every = np.arange(n)
            tokens[every, at] = best
            pick = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])
            tokens = np.take_along_axis(tokens, pick, 1)
            ranks = np.take_along_axis(ranks, pick, 1)
            here, after = tokens[every, at], np.where(at + 1 < width - 1, tokens[every, np.minimum(at + 1, width - 2)], -1)
            ranks[every, at] = self.pairs.find(here, after)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs.find(tokens[left, at[left] - 1], here[left])

    def _heap(self, piece: bytes) -> np.ndarray:
        """The same merges for one very long piece, in L log L steps: the heap gives the leftmost pair of least rank."""
        ids = [int(self.byte[b]) for b in piece]
        after, before = list(range(1, len(ids))) + [-1], list(range(-1, len(ids) - 1))
        heap = [(r, i) for i in range(len(ids) - 1) if (r := self.pairs_of.get(ids[i] << BITS | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or self.pairs_of.get(ids[i] << BITS | ids[j]) != rank:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := self.pairs_of.get(ids[a] << BITS | ids[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([i for i in ids if i >= 0], np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of a list of token ids."""
        return b"".join(map(self.token.__getitem__, ids))

    def _learn(self, texts: list[str]) -> list[list[int]]:
        found = [self.split(text) for text in texts]
        fresh = list(set().union(*found) - self.known.keys())
        for piece, ids in zip(fresh, self.merge([p.encode("utf-8", "replace") for p in fresh]), strict=True):
            self.known[piece] = len(self.ids)
            listed = ids.tolist()
            self.ids.append(ids)
            self.said.append(",".join(map(str, listed)))
            self.back.append(self.decode(listed))
        return [[self.known[p] for p in pieces] for pieces in found]

    def batch(self, texts: list[str]) -> Iterator[list[int]]:
        """For each text the numbers of its pieces in ``ids``, ``said`` and ``back``; valid until the next step."""
        start = 0
        while start < len(texts):
            if len(self.known) > KEPT:
                self.clear()
            end, chars = start, 0
            while end < len(texts) and (end == start or chars + len(texts[end]) <= CHUNK):
                chars += len(texts[end])
                end += 1
            yield from self._learn(texts[start:end])
            start = end

    def encode(self, text: str) -> list[int]:
        """Token ids of one text."""
        (pieces,) = self.batch([text])
        return [i for p in pieces for i in self.ids[p].tolist()]


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, made once in each worker."""
    return Codec(path, pattern)


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and split pattern of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def tokenize(docs: DataFrame, name: str = "byte_bpe_multi_50k.tiktoken", ids: bool = True) -> DataFrame:
    """Encode the whole ``text`` of every document and decode it again.

    Adds ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas), ``decoded_sha256`` (of the
    decoded bytes) and, with ``ids``, the ids themselves; the text goes. Columns of these names are
    replaced, other columns stay. Null text is encoded as the empty text, which has no tokens. Each
    distinct piece of text is merged once per worker; pieces beyond 512 bytes are merged on a heap with
    the same order of merges, because their rounds would cost the square of their length.
    """
    added = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    docs = without(docs, ["n_tokens", "ids_sha256", "decoded_sha256", "ids"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    types += ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(*vocabulary(name))
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            counts, said, back, all_ids = [], [], [], []
            for pieces in bpe.batch(texts):
                parts = [bpe.ids[p] for p in pieces]
                counts.append(sum(map(len, parts)))
                said.append(hashlib.sha256(",".join([bpe.said[p] for p in pieces]).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join([bpe.back[p] for p in pieces])).hexdigest())
                if ids:
                    all_ids.append(np.concatenate(parts) if parts else np.empty(0, np.int32))
            kept = [n for n in batch.schema.names if n != "text"]
            columns = [batch.column(n) for n in kept]
            columns += [pa.array(v, t) for (_, t), v in zip(added, (counts, said, back), strict=True)]
            if ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids])
        bpe.clear()

    return docs.mapInArrow(run, types)


def detokenize(tokens: DataFrame, name: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Turn ``ids`` back into ``text``; null ids give null. Bytes that are no UTF-8 become U+FFFD."""
    tokens = without(tokens, ["text"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(*vocabulary(name))
        for batch in batches:
            texts = [None if x is None else bpe.decode(x).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return tokens.mapInArrow(run, types)
