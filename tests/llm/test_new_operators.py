"""Word BPE against its library, runs against a plain search, ranked search against plain arithmetic; awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfleet.llm import lexical, queries, runs, word_bpe

SCHEMA = "doc_id long, text string, `Runs` int, ids string, score double, item_id int"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", " \n\t", "one two three one", "One, TWO; three 3", "x", "go " * 30, "a b c " * 9 + "a b", "Émile est là ﬁn İstanbul ΣΑΣ 漢字",
             "<|endoftext|>in it's<|startoftext|>", "w" * 5000, "one\x00two", "one two three one"]
    rows = [(i, t, i, "z", 1.0, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3], (None, "one one two", None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_bpe.vocabulary())


def plain_runs(words, least, copies):
    found = {}
    for p in range(1, len(words) // copies + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(least, copies * p):
                found.setdefault((start, i + p), p)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


# Word BPE -----------------------------------------------------------------------------------------------------


def test_word_bpe_equals_its_library(library):
    codec, rng = word_bpe.codec(word_bpe.vocabulary()), random.Random(4)
    odd = [*map(chr, range(32, 127)), *"ÀéîßΣσςİıǅﬁẞẠ̊́̈́ᅡᆨᄀ 　\x1c\x85\xa0²½Ⅷ一가🙂👍🏽՘ᲉꟋ",
           "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "\n"]
    texts = ["", " ", "ab" * 3000, "1" * 300, "é" * 400]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(8)) for _ in range(1500)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        packed, decoded = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want, text
        assert decoded == codec.decode(want) == library.decode(want, skip_special_tokens=False)


def test_word_bpe_over_a_table(spark, docs, library):
    made = word_bpe.tokenize(docs)
    assert made.columns == ["doc_id", "Runs", "score", "item_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        packed, decoded = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), tuple(ids), decoded] += 1
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"]), r["text"]) for r in word_bpe.detokenize(made).collect())
    assert got == want
    assert word_bpe.tokenize(docs.limit(0)).count() == 0


# Runs ---------------------------------------------------------------------------------------------------------


def test_runs_equal_a_plain_search():
    rng = random.Random(2)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 6)):
            words = []
            for _ in range(rng.randint(0, 5)):
                unit = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
                words += unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
            texts.append(words)
        for least, copies in ((6, 4), (2, 2), (3, 3)):
            assert runs.runs_of(texts, least, copies) == [plain_runs(w, least, copies) for w in texts]


def test_suffix_array_equals_sorted_suffixes():
    rng = random.Random(8)
    for _ in range(50):
        symbols = np.array([rng.choice([0, 1, 2, 2, -1]) for _ in range(rng.randint(0, 40))] + [-1])
        array = runs.SuffixArray(symbols)
        named = [s if s >= 0 else -1 - sum(x < 0 for x in symbols[:i]) for i, s in enumerate(symbols.tolist())]
        order = sorted(range(len(named)), key=lambda i: named[i:])
        assert array.order.tolist() == order
        common = [next(k for k in range(len(named)) if named[a + k] != named[b + k]) for a, b in zip(order, order[1:], strict=False)]
        assert array.neighbours().tolist() == [-1, *common, -1]


def test_long_periodic_texts_end():
    for words, want in ((["a"] * 200_000, (0, 200_000, 1)), ([str(i % 777) for i in range(200_000)], (0, 200_000, 777))):
        assert runs.runs_of([words]) == [[want]]


def test_runs_over_a_table(docs):
    made = runs.find_runs(docs)
    assert made.columns == ["doc_id", "ids", "score", "item_id", "n_words", "runs", "collapsed"]
    got = Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in made.collect())
    want = Counter()
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        found = plain_runs(words, 6, 4)
        gone = {i for s, n, p in found for i in range(s + p, s + n)}
        want[r["doc_id"], len(words), tuple(found), " ".join(w for i, w in enumerate(words) if i not in gone)] += 1
    assert got == want
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_runs_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op11_runs(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")
        code, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if code % 10 == 0 and n:
            a = code // 10 % n
            p = 1 + (n - a) // (3 + code // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 2000:
            continue  # the plain search takes the square of the length
        found = plain_runs(words, 6, 4)
        gone = {i for s, k, p in found for i in range(s + p, s + k)}
        best = min(((-k, s, p) for s, k, p in found), default=None)
        told = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{k},{p}\n" for s, k, p in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(found), *told)
        assert (r["runs_sha256"], r["collapsed_sha256"]) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept))


# Ranked search ------------------------------------------------------------------------------------------------


def plain_terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_ranks(items, docs, k):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs if plain_terms(t)]
    n, words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for d, c in counted:
            m = 50 + 50 * sum(c.values()) * n // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out.update((item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(found)[:k]))
    return out


def ranked(frame):
    return Counter(tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect())


def test_ranked_search_equals_plain_arithmetic(spark, docs, monkeypatch):
    rng = random.Random(6)
    word = [*"abcdefghij", "É", "x9", "漢"]
    many = [(i // 2, " ".join(rng.choice(word) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    items = [(i % 40, " ".join(rng.choice([*word, "zz", "-"]) for _ in range(rng.randint(0, 6)))) for i in range(45)] + [(None, "a b"), (7, None), (8, "")]
    table = spark.createDataFrame(many, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    want = plain_ranks(items, many, 7)
    assert ranked(lexical.rank_documents(asked, table, 7)) == want
    # the same with many passes, small tiles, small exact sums, early pruning and a tree of merges
    for name, value in (("PASS", 20), ("ITEMS", 3), ("TERMS", 4), ("DOCS", 11), ("HELD", 30), ("EXACT", 40_000_000), ("FAN_IN", 2)):
        monkeypatch.setattr(lexical, name, value)
    assert ranked(lexical.rank_documents(asked.limit(12), table, 7)) == plain_ranks([tuple(r)[:2] for r in asked.limit(12).collect()], many, 7)
    for name, value in (("PASS", 10**6), ("ITEMS", 2), ("HELD", 5)):
        monkeypatch.setattr(lexical, name, value)
    assert ranked(lexical.rank_documents(asked, table, 7)) == want


def test_ranked_search_over_awkward_tables(spark, docs):
    items = docs.select(F.col("doc_id").alias("item_id"), "text", "score")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert ranked(lexical.rank_documents(items, docs, 5)) == plain_ranks(rows, rows, 5)
    assert lexical.rank_documents(items.limit(0), docs, 5).count() == 0
    assert lexical.rank_documents(items, docs.limit(0), 5).count() == 0


def test_impacts_stay_exact_for_huge_counts():
    got = lexical.impacts(np.array([3]), np.array([10**9]), 10**11, 10**15)
    m = 50 + 50 * 10**9 * 10**11 // 10**15
    assert got.tolist() == [3 * 10**9 // (3000 + 20 * m)]
