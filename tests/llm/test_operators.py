"""The operators on small tables with nulls, ties, repeated rows, no rows and columns of clashing names."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wayfleet.llm import bpe, dart_minhash, line_dedup, mixing, pii, quality_model, quality_rules, sharding, topk, url_trust
from wayfleet.session import settings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string"
RNG = random.Random(9)
PROSE = [" ".join(RNG.choice(["alpha", "beta", "gamma", "delta", "eta", "mu", "nu", "xi", "pi", "rho"]) + str(RNG.randint(0, 40)) for _ in range(120)) for _ in range(6)]


@pytest.fixture(scope="module")
def docs(spark):
    near = PROSE[0].replace(PROSE[0].split()[60], "changed", 1)
    texts = [None, "", PROSE[0], PROSE[0], near, PROSE[1], PROSE[2] + "\nshared line of some length, number one", "x\nshared line of some length, number one",
             "shared line of some length, number one!", PROSE[3], "word", "mail a@b.cd", PROSE[4] * 30]
    rows = [(i, t, "en", ["s", None, "t"][i % 3], len(t or ""), 1.0, "z") for i, t in enumerate(texts)]
    rows += [rows[2], (None, PROSE[5], None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 2), 0) for i in range(13)] + [(3, None, None), (None, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")


def test_every_operator_takes_an_empty_table(spark, docs, labels):
    none = docs.limit(0)
    for frame in (
        sharding.shard(none), dart_minhash.classes(none), dart_minhash.one_of_each(none), bpe.tokenize(none), line_dedup.report(none),
        line_dedup.without_repeats(none), mixing.mix(none), mixing.apply_mix(none), pii.personal_data(none),
        quality_model.classify(none, labels.limit(0)), quality_rules.judge(none, labels.limit(0)),
        url_trust.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")),
    ):
        assert frame.count() == 0


def test_sharding_is_gapless_and_even(docs):
    rows = sharding.shard(docs, 3).collect()
    assert len(rows) == 15
    for s in range(3):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert {r["size"] for r in rows if r["doc_id"] in (0, 1)} == {8}


def test_near_copies_share_a_class(docs):
    got = {r["doc_id"]: r["class_id"] for r in dart_minhash.classes(docs).collect()}
    assert got[2] == got[3] == got[4] == 2 and got[0] == got[1] == 0 and got[5] == 5 and got[None] is None
    kept = dart_minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([0, 2, 5, 6, 7, 8, 9, 10, 11, 12, None])


def test_line_join_equals_brute_force(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng, lines = random.Random(3), set()
    for _ in range(6):
        base = "".join(rng.choice("abé🙂 x") for _ in range(rng.randint(7, 14)))
        for _ in range(12):
            s = list(base)
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(s))
                s[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "🙂"])
            lines.add("".join(s))
    lines = sorted(x for x in lines if len(x) > 5)
    frame = spark.createDataFrame([*enumerate(lines), (0, lines[0])], "id long, line string")
    for edits, crowd in ((1, 3), (2, 50)):
        got = {(r["a"], r["b"]) for r in line_dedup.similar_lines(frame, edits, crowd=crowd).collect()}
        assert got == {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(lines), 2) if distance(a, b) <= edits}


def test_long_line_join_equals_brute_force(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            before, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
        return row[-1]

    def allowed(line):
        pieces = {x for x in re.findall(f"(?s).*?(?:{line_dedup.PIECE_END}|(?!.))", line) if len(x) >= line_dedup.PIECE_CHARS}
        return min(len(line) // line_dedup.PER_EDIT, (len(pieces) - 1) // 2)

    rng, lines = random.Random(5), set()
    for _ in range(8):
        line = " ".join(rng.choice(["morning", "the", "vehicle", "road", "seven", "is", "passed", "with", "traffic", "near"]) for _ in range(60))
        lines.add(line)
        for n in (1, 2, 3, 4, 5, 6, 9):
            s = list(line)
            for _ in range(n):
                at, kind = rng.randrange(len(s)), rng.randrange(3)
                s[at:at + (kind < 2)] = [] if kind == 0 else [rng.choice("abno ")]
            lines.add("".join(s))
    lines = sorted(lines)
    expected = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(lines), 2)
                if min(allowed(a), allowed(b)) > 1 and distance(a, b) <= min(allowed(a), allowed(b))}
    assert any(distance(lines[i], lines[j]) > 3 for i, j in expected)
    frame = spark.createDataFrame([*enumerate(lines), (0, lines[0])], "id long, line string")
    for crowd in (1, 100):
        assert {(r["a"], r["b"]) for r in line_dedup.similar_long_lines(frame, crowd).collect()} == expected


def test_report_equals_brute_force(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            before, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
        return row[-1]

    def allowed(line):
        pieces = {x for x in re.findall(f"(?s).*?(?:{line_dedup.PIECE_END}|(?!.))", line) if len(x) >= line_dedup.PIECE_CHARS}
        return min(len(line) // line_dedup.PER_EDIT, (len(pieces) - 1) // 2)

    rng, docs = random.Random(21), []
    word = ["morning", "the", "vehicle", "road", "seven", "is", "passed", "with", "traffic", "near", "é", "漢字"]
    bases = [" ".join(rng.choice(word) for _ in range(n)) for n in (1, 2, 4, 10, 17, 18, 19, 20, 21, 22, 24, 30, 45)] + ["x" * 130, "ab" * 70, "a", "bc"]
    for base in bases:
        for n in (0, 0, 1, 1, 2, 3, 5):
            s = list(base)
            for _ in range(n):
                at, kind = rng.randrange(len(s) + 1), rng.randrange(3)
                s[at:at + (kind < 2)] = [] if kind == 0 else [rng.choice("abno ")]
            docs.append("".join(s))
    rng.shuffle(docs)
    docs = ["\n".join([*docs[i:i + 4], "", " "]) for i in range(0, len(docs), 4)]
    rows = [(i, t) for i, t in enumerate(docs)]
    lines = sorted({x for t in docs for x in t.split("\n") if x.strip(" \t\r")})
    near, root = Counter(), {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(lines, 2):
        k = max(min(allowed(a), allowed(b)) if min(allowed(a), allowed(b)) > 1 else 0, int(min(len(a), len(b)) > 3))
        if abs(len(a) - len(b)) <= k and distance(a, b) <= k:
            near.update((a, b))
            root[find(a)] = find(b)
    seen, want = set(), {}
    for i, text in rows:
        gone = []
        for at, x in enumerate(text.split("\n")):
            if x in root:
                if find(x) in seen:
                    gone.append(at)
                seen.add(find(x))
        want[i] = (gone, sum(near[x] for x in text.split("\n")))
    got = {r["doc_id"]: (r["removed"], r["n_links"]) for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(n for _, n in want.values()) > 100
    assert got == want


def test_long_lines_with_a_changed_word_are_near(spark):
    line = " ".join(f"{w} wonderful{i}" for i, w in enumerate(["morning", "vehicle", "road", "passed", "traffic"] * 8))
    docs = spark.createDataFrame([(0, line), (1, line.replace("wonderful7 ", "marvellous7 ")), (2, line[:300])], "doc_id long, text string")
    report = {r["doc_id"]: r for r in line_dedup.report(docs).collect()}
    assert [(report[i]["removed"], report[i]["n_links"]) for i in range(3)] == [([], 1), ([0], 1), ([], 0)]


def test_a_large_group_of_long_lines_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice("bcdfghjk") for _ in range(11)) + "e" for _ in range(36)]
    lines = [" ".join(words)] + [" ".join([*words[:i], words[i].replace(words[i][4], "w"), *words[i + 1:]]) for i in range(36)]
    asked, paired = [], line_dedup._paired

    def spy(pairs, texts):
        asked.append(pairs.count())
        return paired(pairs, texts)

    monkeypatch.setattr(line_dedup, "_paired", spy)
    frame = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    found = {(r["a"], r["b"]) for r in line_dedup.similar_long_lines(frame).collect()}
    assert found == set(itertools.combinations(range(37), 2))
    assert sum(asked) <= 3 * len(lines)


def test_a_large_group_is_verified_without_a_row_for_a_pair(spark, monkeypatch):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            before, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
        return row[-1]

    rng = random.Random(9)
    words = ["".join(rng.choice("bcdfghjk") for _ in range(11)) + "e" for _ in range(25)]
    lines = [" ".join(words)]
    for _ in range(40):
        changed = list(words)
        for i in rng.sample(range(25), 5):
            at = rng.randrange(11)
            changed[i] = changed[i][:at] + rng.choice("wé") + changed[i][at + 1:]
        lines.append(" ".join(changed))
    expected = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(lines), 2) if distance(a, b) <= 8}
    assert 60 < len(expected) < 700
    asked, paired = [], line_dedup._paired
    monkeypatch.setattr(line_dedup, "_paired", lambda pairs, texts: asked.append(pairs.count()) or paired(pairs, texts))
    frame = spark.createDataFrame([*enumerate(lines), (0, lines[0])], "id long, line string")
    for block in (512, 7):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        assert {(r["a"], r["b"]) for r in line_dedup.similar_long_lines(frame).collect()} == expected
    assert sum(asked) <= 3 * 2 * len(lines)
    # links are counted, and edges lead from each line to all that links lead to
    for counted in (True, False):
        pairs, _, inside = line_dedup.long_links(frame, counted=counted)
        root = {i: i for i in range(len(lines))}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        rows = inside.collect()
        for x, y in [(r["id"], y) for r in rows for y in r["edges"]] + [(r["a"], r["b"]) for r in pairs.collect()]:
            assert (min(x, y), max(x, y)) in expected
            root[find(x)] = find(y)
        assert all(find(i) == find(j) for i, j in expected)
        if counted:
            links = Counter()
            for r in rows:
                links[r["id"]] += r["links"]
            assert +links == Counter(i for pair in expected for i in pair)


def test_lines_are_measured_as_their_pieces_say(spark):
    rng = random.Random(2)
    words = ["morning", "the", "vehicle", "é", "漢字road", "wonderful7", "seven", "is"]
    lines = ["", "x" * 130, "e " * 60, " " * 90, "é漢" * 60, "morning the " * 20]
    lines += [rng.choice(["", " "]) + " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice(["", " ", "e ", "\t"]) for _ in range(200)]
    got = {r["id"]: r for r in line_dedup.measured(spark.createDataFrame(list(enumerate(lines)), "id long, line string")).collect()}
    for i, line in enumerate(lines):
        pieces = {x for x in re.findall(f"(?s).*?(?:{line_dedup.PIECE_END}|(?!.))", line) if len(x) >= line_dedup.PIECE_CHARS}
        several = len(line) >= 80 and len(pieces) >= 5
        assert got[i]["allowed"] == (min(len(line) // 40, (len(pieces) - 1) // 2) if several else None)
        assert len(set(got[i]["keys"])) == len(got[i]["keys"]) == (len(pieces) if several else 0)
        assert got[i]["rest"] == (line if len(line) <= 80 or len(pieces) < 7 else None)


def test_pieces_of_long_lines_are_shuffled_once(spark, monkeypatch):
    lines = [" ".join(f"{w} wonderful{i}" for i, w in enumerate(["morning", "vehicle", "road"] * 8)), "other wonderful3 " * 9]
    plans, cut = [], line_dedup.cut
    monkeypatch.setattr(line_dedup, "cut", lambda frame: plans.append(frame._jdf.queryExecution().executedPlan().toString()) or cut(frame))
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        line_dedup.long_links(spark.createDataFrame(list(enumerate(lines)), "id long, line string"))
    assert "ReusedExchange" in plans[0]


def test_few_rows_left_of_many_are_few_files(spark):
    keys = spark.range(0, 20_000, 1, 4).select(F.when(F.col("id") < 2, 0).otherwise(F.col("id")).alias("key"), "id")
    small = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    with settings(spark, small):
        live = line_dedup._shared(keys)
        assert live.rdd.getNumPartitions() <= 2
    assert sorted(tuple(r) for r in live.collect()) == [(0, 0), (0, 1)]


def test_lines_with_other_letters_are_not_verified(spark, monkeypatch):
    line = " ".join(f"{w} wonderful{i}" for i, w in enumerate(["morning", "vehicle", "road", "flight", "traffic"] * 2))
    near, far = line.replace("road", "roof", 1), line.replace("w", "q", 8)
    asked, paired = [], line_dedup._paired
    monkeypatch.setattr(line_dedup, "_paired", lambda pairs, texts: asked.append(pairs.count()) or paired(pairs, texts))
    frame = spark.createDataFrame(list(enumerate([line, near, far])), "id long, line string")
    assert {(r["a"], r["b"]) for r in line_dedup.similar_long_lines(frame).collect()} == {(0, 1)}
    assert asked == [1]


def test_later_lines_go_and_other_columns_stay(docs):
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(docs).collect()}
    assert got[6].endswith("number one") and got[7] == "x" and got[8] == "" and got[0] is None and got[3] == ""
    report = {r["doc_id"]: r for r in line_dedup.report(docs).collect()}
    assert report[7]["removed"] == [1] and report[8]["n_links"] == 1 and report[0]["n_removed"] == 0


def test_short_lines_are_compared(spark):
    texts = ["ok\nshort line here\n\n\t", "ok\nshort lime here\n\n\t", "no\nok\nshort line here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    report = {r["doc_id"]: r for r in line_dedup.report(docs).collect()}
    assert [report[i]["removed"] for i in range(3)] == [[], [0, 1], [1, 2]]
    assert [report[i]["n_links"] for i in range(3)] == [1, 1, 1]


def test_mix_meets_targets_and_agrees_with_itself(docs):
    rows = mixing.mix(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    assert all(r["copies"] <= 3 for r in rows) and len(rows) == 15
    total = {r["source"]: (r["source_size"], r["target"]) for r in rows}
    assert abs(sum(s for s, _ in total.values()) - sum(t for _, t in total.values())) < 1e-6
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)


def test_tokens_replace_clashing_columns(docs):
    rows = {r["doc_id"]: r for r in bpe.tokenize(docs).collect()}
    assert rows[0]["n_tokens"] == 0 and rows[0]["ids"] == [] and rows[10]["lang"] == "en"
    back = {r["doc_id"]: r["text"] for r in bpe.detokenize(bpe.tokenize(docs)).collect()}
    assert back[6] == PROSE[2] + "\nshared line of some length, number one" and back[0] == ""


def test_personal_data_counts(docs):
    rows = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    assert rows[11]["n_email"] == 1 and rows[11]["spans"] == "email:5:11" and rows[0]["spans"] == ""


def test_classifier_scores_every_row(docs, labels):
    rows = quality_model.classify(docs, labels).collect()
    assert len(rows) == 15 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert quality_model.good_documents(docs, labels).columns == docs.columns


def test_copies_are_sampled_one_by_one(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_model, "fit", lambda x, y: seen.append((len(y), int(y.sum()))))
    vector = lambda i: [float(i)] * len(quality_model.FEATURES)
    for value in (-1, -2, -3):
        known = spark.createDataFrame([(i, vector(value if i < 300 else i)) for i in range(900)], "doc_id long, _x array<double>")
        quality_model.train(known, spark.createDataFrame([(i, int(i < 300)) for i in range(900)], "doc_id long, quality int"), 90)
    assert all(n == 90 and 10 < good < 55 for n, good in seen) and len(seen) == 3


def test_rules_equal_brute_force(docs, labels):
    for r in quality_rules.judge(docs, labels.where("quality = 1")).join(docs.select("doc_id", F.col("text").alias("t")), "doc_id").collect():
        words = (r["t"] or "").split()
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = Counter(triples)
        covered = {k for i, t in enumerate(triples) if often[t] > 1 for k in range(i, i + 3)}
        assert (r["n_words"], r["n_repeat_words"]) == (len(words), len(covered))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_urls_follow_rules_then_hosts(spark):
    link = '<a href="http://bad.com/">x</a>'
    rows = [(1, "http://A.Example.NET/en/x?y", None), (2, "https://a.net", ""), (3, "http://bad.com/x", ""), (4, "http://q.com/", link), (5, None, link),
            (6, "no scheme", None), (7, "http://www.example.com/de/1", None), (8, "http://www.example.com/de/2", None), (9, "http://www.example.com/en/", None)]
    got = {r["page_id"]: r for r in url_trust.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2]["rule"] is None and got[2]["verdict"] == "allow" and got[5]["host"] == "" and got[6]["verdict"] == "allow"
    assert got[7]["verdict"] == "block" and got[9]["verdict"] == "block" and got[9]["rule"] is None


def test_distrust_reaches_hosts_of_a_domain_without_pages(spark):
    urls = [f"http://{h}.farm.com/x" for h in "abcdef"] + ["http://m.new.farm.com/x", "http://lone.other.com/x", "http://a.mixed.com/x", "http://b.mixed.com/bad", "http://c.mixed.com/x"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    rules = [url_trust.Rule("block", f"{h}.farm.com", "/") for h in "abcdef"] + [url_trust.Rule("block", "mixed.com", "/bad")]
    got = {r["host"]: r for r in url_trust.judge_urls(pages, rules).collect()}
    assert got["m.new.farm.com"]["rule"] is None and got["m.new.farm.com"]["verdict"] == "block"
    assert got["lone.other.com"]["distrust"] == 0 and {got[f"{h}.mixed.com"]["verdict"] for h in "ac"} == {"allow"}


def test_top_k_breaks_ties_by_id(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(45)] + [(None, [9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, ints array<double>")
    got = topk.top_k(frame.where("vec_id % 20 = 0"), frame, 5).collect()
    vectors = dict(rows)
    for q in (0, 20, 40):
        score = lambda j: sum(a * b for a, b in zip(vectors[q], vectors[j]))  # noqa: B023,E731
        expected = sorted((j for j in vectors if j is not None and j != q), key=lambda j: (-score(j), j))[:5]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == expected


def test_top_k_keeps_components_beyond_32_bits(spark):
    vectors = {0: [3.0, 1.0], 1: [2.0**40 + 1, 5.0], 2: [2.0**40, 7.0], 3: [-(2.0**45), 2.0**33]}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, ints array<double>")
    got = [(r["vec_id"], r["score"]) for r in topk.top_k(frame.where("vec_id = 0"), frame, 5).orderBy("rank").collect()]
    assert got == [(1, 3 * 2**40 + 8), (2, 3 * 2**40 + 7), (3, -3 * 2**45 + 2**33)]


def test_pipeline_runs_its_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "mix", "tokens"]
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and {"doc_id", "n_tokens", "ids", "decoded_sha256"} <= set(rows.columns)


def test_lines_with_a_common_piece_do_not_become_one_group(spark):
    rng = random.Random(12)
    lines = [" ".join(["everywhere" * 3] + ["".join(rng.choice("bcdfghjk") for _ in range(11)) + "e" for _ in range(13)]) for _ in range(100)]
    lines.append(lines[0].replace("b", "w", 1))
    frame = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    pairs, groups, inside = line_dedup.long_links(frame)
    assert [tuple(r) for r in pairs.collect()] == [(0, 100)]
    assert groups.count() == inside.count() == 0


def test_near_lines_share_one_of_their_rarest_pieces():
    rng = random.Random(13)
    words = ["".join(rng.choice("abcdehno") for _ in range(rng.randint(1, 18))) for _ in range(40)]
    for _ in range(60):
        line = " ".join(rng.choice(words) for _ in range(rng.randint(30, 90)))
        lines = [line]
        for n in range(1, 12):
            s = list(line)
            for _ in range(n):
                at, kind = rng.randrange(len(s)), rng.randrange(3)
                s[at:at + (kind < 2)] = [] if kind == 0 else [rng.choice("abno ")]
            lines.append("".join(s))
        ids, texts = pa.array(range(12)), pa.array(lines)
        some = np.unique(line_dedup._pieces(texts)[5])
        some = some[np.array([rng.random() < 0.5 for _ in some])]
        got = line_dedup._measure(ids, texts, (some, np.array(rng.sample(range(len(some)), len(some)), np.int64))).to_pylist()
        assert all(len(r["keys"]) <= 2 * r["allowed"] + 1 for r in got if r["allowed"] is not None)
        for n, r in enumerate(got):
            if r["allowed"] is not None and got[0]["allowed"] is not None and n <= min(r["allowed"], got[0]["allowed"]):
                assert set(r["keys"]) & set(got[0]["keys"])
