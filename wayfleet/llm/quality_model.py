"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import cut, without

#: Labelled rows the model is fitted on, at most (a sample by hash beyond that).
SAMPLE = 20_000
#: Statistics of a text, in the order of its feature vector.
FEATURES = (
    "log_bytes", "log_words", "log_lines", "upper", "lower", "digit", "high", "space", "comma", "stop", "bang",
    "pipe", "hash_", "dollar", "percent", "amp", "star", "other_punct", "mean_word", "sd_word", "longest_word",
    "distinct_words", "top_word", "distinct_lines", "words_per_line", "ends_in_punct", "entropy", "distinct_pairs",
)


def _groups() -> np.ndarray:
    """For each byte value, which of the counted groups of characters it belongs to."""
    table = np.zeros((256, 14))
    groups = [(range(65, 91), 0), (range(97, 123), 1), (range(48, 58), 2), (range(128, 256), 3), ([32, 9, 10, 11, 12, 13], 4)]
    groups += [([ord(c)], 5 + i) for i, c in enumerate(",.!|#$%&")]
    for codes, at in groups:
        table[list(codes), at] = 1
    table[ord("*"), 13] = 1
    return table


_TABLE = _groups()
_OTHER = np.array([float(33 <= c < 127 and not chr(c).isalnum() and chr(c) not in ",.!|#$%&*") for c in range(256)])
_PUNCT = frozenset(b".,!?;:|#$%&*")


def statistics(text: str) -> list[float]:
    """Feature vector of one whole text; all zeros for the empty text."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (counts @ _TABLE) / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1, np.int64)
    often: dict[bytes, int] = {}
    for w in words:
        often[w] = often.get(w, 0) + 1
    seen = counts[counts > 0] / len(raw)
    pairs = len(set(zip(words, words[1:], strict=False))) / (n - 1) if n > 1 else 1.0
    return [
        float(np.log1p(len(raw))), float(np.log1p(n)), float(np.log1p(len(lines))),
        *shares[:5].tolist(), *shares[5:14].tolist(), float(counts @ _OTHER) / len(raw),
        float(lengths.mean()), float(lengths.std()), float(lengths.max()),
        len(often) / max(1, n), max(often.values(), default=0) / max(1, n), len(set(lines)) / len(lines), n / len(lines),
        sum(w[-1] in _PUNCT for w in words) / max(1, n), float(-(seen * np.log(seen)).sum()), pairs,
    ]


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_x``, the statistics of the whole ``text`` (null: empty), in place of the text."""
    docs = without(docs, ["_x"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text") + ", _x array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics("" if t is None else t) for t in batch.column("text").to_pylist()], np.float32)
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(list(rows), pa.list_(pa.float32()))], [*kept, "_x"])

    return docs.mapInArrow(run, types)


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in arrays: a row goes to child 2i+1, or 2i+2 where its feature exceeds the limit."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of label 1 for each row; all trees go down a level at a time."""
        if not len(self.feature):
            return np.full(len(x), self.base)
        trees, inner = self.feature.shape
        node, tree, row = np.zeros((len(x), trees), np.int64), np.arange(trees), np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.limit[tree, node])
        return self.base + self.leaf[tree, node - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Forest:
    """Boost ``trees`` trees of ``depth`` on histograms of ``bins`` quantiles, by logistic loss.

    Without rows, or with rows of one label, the score is the smoothed share of label 1.
    """
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base, inner = float(np.log(share / (1 - share))), 2**depth - 1
    feature, limit, leaf = [], [], []
    if len(y) == 0 or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    offset = np.arange(x.shape[1]) * bins
    margin = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        f_row, l_row = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            width = 2**level
            at = (((node - (width - 1)) * x.shape[1] * bins)[:, None] + offset + binned).ravel()
            size = width * x.shape[1] * bins
            g = np.bincount(at, np.repeat(grad, x.shape[1]), size).reshape(width, x.shape[1], bins).cumsum(axis=2)
            h = np.bincount(at, np.repeat(hess, x.shape[1]), size).reshape(width, x.shape[1], bins).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least)] = -np.inf
            for w in range(width):
                f, b = divmod(int(gain[w].argmax()), bins)
                if gain[w, f, b] > 1e-9 and b < len(cuts[f]):
                    f_row[width - 1 + w], l_row[width - 1 + w] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), f_row[node]] > l_row[node])
        end = node - inner
        value = rate * np.bincount(end, grad, inner + 1) / (np.bincount(end, hess, inner + 1) + ridge)
        margin += value[end]
        feature.append(f_row)
        limit.append(l_row)
        leaf.append(value)
    return Forest(base, np.array(feature), np.array(limit), np.array(leaf))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; a null id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def train(known: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on the labelled rows of ``known`` (``doc_id``, ``_x``) that are not held out.

    A document labelled more than once counts as what most of its labels say (good on a tie); null labels are
    left out. Beyond ``sample`` rows, those with the least hash of id and statistics are taken.
    """
    votes = labels.where("quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("_y"))
    rows = known.select("doc_id", "_x").where(~held_out(F.col("doc_id"))).join(votes, "doc_id").select(F.xxhash64("doc_id", "_x").alias("_h"), "doc_id", "_x", "_y")
    rows = cut(rows)
    n = rows.count()
    if n > sample:
        bound = min(int(-(2**63) + 2**64 * (sample / n) * 1.05), 2**63 - 1)
        rows = rows.where(F.col("_h") <= F.lit(bound)).orderBy("_h", "doc_id").limit(sample)
    got = rows.select("_h", "_x", "_y").toPandas().sort_values("_h", kind="stable")
    x = np.array(got["_x"].tolist(), np.float32).reshape(len(got), len(FEATURES))
    order = np.lexsort((*x.T, got["_y"].to_numpy()))
    return fit(x[order], got["_y"].to_numpy(float)[order])


def score(known: DataFrame, forest: Forest) -> DataFrame:
    """Add ``score`` (probability of label 1) and ``predicted`` to rows with ``_x``."""
    known = without(known, ["score", "predicted"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.schema if f.name != "_x") + ", score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            p = forest.score(x)
            kept = [n for n in batch.schema.names if n != "_x"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*kept, "score", "predicted"])

    return known.mapInArrow(run, types)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every row of ``docs`` without its text, with ``held_out``, ``score`` and ``predicted`` (1 from 0.5 on).

    Statistics are taken of whole texts, once; ids, language, source and labels are no part of them. Null text
    counts as empty and is scored like any other. Repeated rows get the same score. Columns of the result's names
    are replaced, others stay. Without labels every score is 0.5.
    """
    known = cut(features(without(docs, ["held_out", "score", "predicted"])))
    forest = train(known, labels, sample)
    return score(known.withColumn("held_out", held_out(F.col("doc_id"))), forest)


def good_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier does not reject, with the columns they had.

    The statistics of each row are made twice, for the model and beside the row, so that texts are never shuffled.
    """
    known = cut(features(docs.select("doc_id", "text")))
    forest = train(known, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics("" if t is None else t) for t in batch.column("text").to_pylist()], np.float32)
                yield batch.filter(pa.array(forest.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
