"""The vectorised helpers against plain ones."""

import base64
import random
import re
import time

import numpy as np
import pytest
import tiktoken

from wayfleet.llm import bpe, dart_minhash, mixing, pii, quality_model, sharding, topk


def test_bpe_equals_the_reference_library_and_round_trips():
    path, pattern = bpe.vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    expected = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec, rng = bpe.codec(path, pattern), random.Random(5)
    texts = ["", " ", "\n\n  x", "ab" * 700, "é" * 900 + "漢字🙂", "a" * 20_000]
    texts += ["".join(rng.choice("abcdeéßñ漢字🙂 \n\t.,!1234 Ωж") for _ in range(n)) for n in (1, 7, 80, 4000)]
    for text in texts:
        ids = codec.encode(text)
        assert ids == expected.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_emails_equal_the_plain_pattern():
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("ab1@@..-+ _é") for _ in range(rng.randint(0, 25)))
        assert [m.span() for m in plain.finditer(text)] == [(s.start, s.end) for s in pii.emails(text)]


@pytest.mark.parametrize(("text", "kind", "find"), [
    ("write to john (at) example (dot) com now", "email", "john (at) example (dot) com"),
    ("mail john at example dot com please", "email", "john at example dot com"),
    ("іvаn@ехаmple.com", "email", "іvаn@ехаmple.com"),
    ("ip one nine two dot one six eight dot one dot two five", "ip", "one nine two dot one six eight dot one dot two five"),
    ("１９２.１６８.１.１", "ip", "１９２.１６８.１.１"),
    ("card four" + " one" * 15, "card", "four" + " one" * 15),
])
def test_disguises_are_found_at_their_place(text, kind, find):
    base, every = pii.find_personal(text)
    assert base == []
    assert [(s.kind, text[s.start:s.end]) for s in every] == [(kind, find)]


@pytest.mark.parametrize(("text", "kind", "find"), [
    ("call +49 one 5 one 7 two 3 four 5 now", "phone", "+49 one 5 one 7 two 3 four 5"),
    ("at 192 dot 168 dot 1 dot 17 there", "ip", "192 dot 168 dot 1 dot 17"),
    ("call plus 49 151 234 5678 now", "phone", "plus 49 151 234 5678"),
    ("to john.doe@mail.example [dot] com now", "email", "john.doe@mail.example [dot] com"),
])
def test_mixed_disguises_are_found(text, kind, find):
    assert (kind, find) in [(s.kind, text[s.start:s.end]) for s in pii.find_personal(text)[1]]


def plain_spans(text):
    """The four patterns as they are, each kind by itself."""
    def luhn(digits):
        doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))]
        return sum(doubled) % 10 == 0

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]


def test_base_finds_equal_the_plain_patterns():
    rng = random.Random(12)
    parts = ["1", "25", "256", "0" * 25 + "7", ".", "..", "+", "+49", " ", "-", "(", ")", "@", "a", "b.c", "%", "4111 1111 1111 1111", "4111-1111-1111-1111", "5500000000000004", "٣", "é"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        base, every = pii.find_personal(text)
        assert [tuple(s) for s in base] == plain_spans(text), text
        assert set(base) <= set(every)


def test_zeros_before_a_part_do_not_hide_an_address():
    assert pii.find_personal("x " + "0" * 25 + "1.2.3.4")[0] == [("ip", 2, 34)]


@pytest.mark.parametrize("unit", ["1", ".", "-", "a_", " ", "a dot ", "at ", "1.", "one two ", "a@b.cd ", "a (at) b (dot) cd ", "(", "x at a dot ", "x" * 400 + "а"])
def test_search_takes_time_in_proportion(unit):
    def seconds(n):
        text = unit * (n // len(unit)) + " one two three"
        start = time.perf_counter()
        pii.find_personal(text)
        return time.perf_counter() - start

    assert seconds(1_000_000) < 5


def test_clean_text_has_no_finds():
    for text in ("look at example.com and", "one two three, four.", "un un un un la", "", "a@b", "300.1.1.1", "1234 5678 9012 3456"):
        assert pii.find_personal(text) == ([], [])


def test_pivotal_rounding_keeps_the_sum_and_leaves_one_open():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 400).astype(float)
    mass = size * rng.random(400)
    total = mass.sum()
    held = mixing.pivot(size, mass, np.arange(400), rng)
    assert abs(mass.sum() - total) < 1e-6
    assert [i for i in range(400) if 0 < mass[i] < size[i]] == ([held] if held >= 0 else [])


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(2)
    items = np.unique(rng.integers(1, 2**63, 300).astype(np.uint64))
    a = (items, rng.integers(1, 6, len(items)))
    b = (items, np.where(rng.random(len(items)) < 0.3, rng.integers(1, 6, len(items)), a[1]))
    left, right = dart_minhash.signatures([a, b], 4000)
    assert abs((left == right).mean() - dart_minhash.similarity(a, b)) < 0.04


def test_level_evens_loads():
    ends = sharding.level([100.0, 0, 0], [(1, 1000, 5000.0), (0, 7, 7.0)])
    assert ends[1][-1] == 1000 and ends[0][-1] == 7
    counts = np.diff([0, *ends[1]]) * 5 + np.diff([0, *ends[0]])
    assert np.ptp(counts + np.array([100, 0, 0])) <= 6


def test_products_are_exact_beyond_doubles():
    a, b = np.array([[2**31 - 1, 2**31 - 1, 3]]), np.array([[2**31 - 1, 2**31 - 2, 7, 9]])
    assert topk.products(a, b)[0, 0] == (2**31 - 1) ** 2 + (2**31 - 1) * (2**31 - 2) + 21


def test_best_leaves_out_every_row_of_the_own_id():
    rng = np.random.default_rng(2)
    ids = np.sort(np.concatenate([np.arange(150), np.full(90, 7), np.full(2, 9)]))
    own = np.array([7, 9, 20, 999])
    scores = rng.integers(0, 12, (4, len(ids)))
    scores[0, ids == 7] = scores[1, ids == 9] = 99
    counts, got_ids, got_scores = topk.best(scores, ids, own, 20)
    expected = [sorted((-s, i) for s, i in zip(row.tolist(), ids.tolist()) if i != mine)[:20] for row, mine in zip(scores, own)]
    assert counts.tolist() == [20] * 4
    assert list(zip((-got_scores).tolist(), got_ids.tolist())) == [pair for row in expected for pair in row]


def test_boosted_trees_learn_a_rule_and_score_without_labels():
    rng = np.random.default_rng(4)
    x = rng.random((2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    forest = quality_model.fit(x[:1500], y[:1500])
    assert ((forest.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    assert quality_model.fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
