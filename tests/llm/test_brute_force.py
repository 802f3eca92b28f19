"""Whole operators on the driver's small tables against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wayfleet.llm import dart_minhash, mixing, quality_model, quality_rules, queries, sharding

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_shards_are_even_and_keep_equal_texts_together(spark, texts):
    rows = queries.op1_sharding(spark, SMALL).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(texts.keys())
    load, shards, slots = Counter(), defaultdict(set), defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw)
        load[r["shard"]] += r["size"]
        shards[raw].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert set(load) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in shards.values()) == 0
    # one text may be larger than a shard's share, and nothing can be done about it
    mean, largest = sum(load.values()) / 24, max(r["size"] for r in rows)
    assert max(load.values()) <= max(1.05 * mean, largest)


@pytest.mark.parametrize("rows", [600, 30])
def test_shards_are_even_when_one_text_repeats(spark, rows):
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.lit("the same words").alias("text"))
    load = Counter(r["shard"] for r in sharding.shard(docs, 4).collect())
    assert sum(load.values()) == rows


def test_near_dedup_finds_every_pair(spark, texts):
    windows = {d: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for d, w in ((d, words(t)) for d, t in texts.items())}
    near = [(a, b) for a in windows for b in windows if a < b and windows[a] and windows[b]
            and sum((windows[a] & windows[b]).values()) >= 0.8 * sum((windows[a] | windows[b]).values())]
    assert len(near) > 5
    found = {r["doc_id"]: r["class_id"] for r in dart_minhash.classes(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    assert sum(found[a] == found[b] for a, b in near) >= 0.9 * len(near)
    # and links nothing that no chain of such pairs links
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    equal = defaultdict(list)
    for d, t in texts.items():
        equal[t or ""].append(d)
    for a, b in near + [(g[0], d) for g in equal.values() for d in g[1:]]:
        root[find(a)] = find(b)
    together = defaultdict(set)
    for d, c in found.items():
        together[c].add(find(d))
    assert all(len(roots) == 1 for roots in together.values())


def test_mix_meets_its_targets(spark, texts):
    rows = mixing.mix(spark.read.parquet(f"{MIDDLE}/documents.parquet")).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    # shares by weight, what is above three times a source going to the others, until nothing is
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    want, full = {}, set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        share = {s: weight[s] * rest / sum(weight[t] for t in weight if t not in full) for s in weight if s not in full}
        over = {s for s in share if share[s] > 3 * size[s]}
        want = {**share, **{s: 3 * size[s] for s in full}}
        if not over:
            break
        full |= over
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= max(50, 0.01 * want[s])


def test_mix_deals_repeated_rows_to_several_leaves(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 16)
    same = spark.range(400).select(F.lit(1).alias("doc_id"), F.lit("a b c d").alias("text"), F.lit("s").alias("source"))
    other = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("t").alias("source"))
    rows = mixing.mix(same.union(other)).collect()
    assert Counter(r["source"] for r in rows) == {"s": 400, "t": 400}
    for source, size in (("s", 4), ("t", 2)):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["copies"] * r["size"] for r in own) == pytest.approx(own[0]["target"], abs=size)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix(same.union(other)).collect()))


def test_quality_model_holds_out_rows(spark):
    scored = quality_model.classify(spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{MIDDLE}/labels.parquet"))
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = scored.collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and marks.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    most = max(Counter(marks[r["doc_id"]] for r in held).values()) / len(held)
    right = sum(r["predicted"] == marks[r["doc_id"]] for r in held) / len(held)
    assert len(held) > 100 and right > most + 0.05


def test_quality_rules_count_as_written(spark, texts):
    trusted = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1")
    rows = quality_rules.judge(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), trusted).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeated = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        assert r["base_failed"] == failed and not (failed and r["kept"])
        assert failed or r["kept"] == (r["llr"] >= quality_rules.THRESHOLD)
