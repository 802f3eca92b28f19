"""Personal data in text, also when disguised: base patterns and an offset-preserving deobfuscation."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from wayfleet.llm.common import without

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPACE = re.compile(r"\s")
_NOT_DIGIT = re.compile(r"[^0-9]")


class Span(NamedTuple):
    """A find: kind and code points, end exclusive."""

    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    """The check digit of a card number fits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost, non-overlapping addresses. Each ``@`` is tried with the whole run before it, so a long run costs its length."""
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield Span("email", start, m.end())
            last = m.end()


def ips(text: str) -> Iterator[Span]:
    """Leftmost, non-overlapping fours of numbers with dots between, each at most 255 whatever its zeros. A chain of
    numbers is read once: its first four are the first match, and the next one starts behind them."""
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield Span("ip", at, end)
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """Addresses, IPv4 addresses, card numbers and phone numbers as written, each kind by itself."""
    found = list(emails(text)) if "@" in text else []
    found += ips(text)
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(Span("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(Span("phone", *m.span()))
    return found


# Letters of other scripts that look like a Latin one, a pair each.
_LOOKS = "аaеeоoрpсcуyхxіiјjѕsԁdһhӏlԛqԝwАAВBЕEКKМMНHОOРPСCТTХXІIЈJЅSαaοoρpνvυuιiκkΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX"
_GLYPHS = {ord(_LOOKS[i]): _LOOKS[i + 1] for i in range(0, len(_LOOKS), 2)}
_GLYPHS |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}  # full-width forms
_GLYPHS |= {start + i: str(i) for start in (0x660, 0x6F0, 0x966) for i in range(10)}  # digits of other scripts
_GLYPHS |= {0x1D7CE + i: str(i % 10) for i in range(50)}  # mathematical digits
_GLYPHS |= {0x2024: ".", 0xFE52: ".", 0x3002: ".", 0xFE6B: "@", 0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-", 0xFE63: "-", 0x2212: "-"}
_GLYPHS |= {c: " " for c in (0xA0, 0x2007, 0x2009, 0x202F)}
#: Characters that show nothing.
_HIDDEN = frozenset({0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF})
#: Spelled digits and the words for signs, in the languages of the corpus.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
SIGNS = {"at": "@", "arobase": "@", "arroba": "@", "klammeraffe": "@", "dot": ".", "punkt": ".", "point": ".", "punto": "."}

_ODD = re.compile("[" + re.escape("".join(map(chr, sorted({*_GLYPHS, *_HIDDEN})))) + "]")
_SIGN = "|".join(sorted(SIGNS, key=len, reverse=True))
_BRACKET = re.compile(rf"(?:\([ \t]*({_SIGN}|@|\.)[ \t]*\)|\[[ \t]*({_SIGN}|@|\.)[ \t]*\]|\{{[ \t]*({_SIGN}|@|\.)[ \t]*\}}|<[ \t]*({_SIGN}|@|\.)[ \t]*>)[ \t]*", re.I)
_DOTS, _WORD = frozenset({"dot", "punkt", "point", "punto"}), frozenset(_LOCAL - {"."})
#: What follows a spoken "at" and the sign itself: a name with a spoken dot before its last part.
_SPOKEN_AT = re.compile(r"(?<=[A-Za-z0-9_%+-])[ \t]+(?:at|arobase|arroba)[ \t]+", re.I)
_SPOKEN_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:[ \t]+(?:dot|punkt|point|punto)[ \t]+|\.)[A-Za-z0-9-]+)*[ \t]+(?:dot|punkt|point|punto)[ \t]+[A-Za-z]{2,}(?![A-Za-z0-9])", re.I)
_WORD_SIGN = re.compile(r"[ \t]+(at|arobase|arroba|dot|punkt|point|punto)[ \t]+", re.I)
_SPOKEN_DOT = re.compile(r"[ \t]+(?:dot|punkt|point|punto|\.)[ \t]+", re.I)
_AFTER_AT = re.compile(r"@[ \t]*[A-Za-z0-9-]+(?:(?:[ \t]+(?:dot|punkt|point|punto|\.)[ \t]+|\.)[A-Za-z0-9-]+)+", re.I)
_DIGIT_WORD = "|".join(sorted(DIGITS, key=len, reverse=True))
_DOT, _GAP = "dot|punkt|point|punto", r"(?:[ \t]*[-.,][ \t]*|[ \t]+)"
_SPELLED = re.compile(rf"(?<!\w)(?:\+|plus[ \t]+)?(?:(?:{_DIGIT_WORD}|[0-9]+)(?:[ \t]*[-.,][ \t]*|[ \t]+(?:(?:dot|punkt|point|punto)[ \t]+)?)){{3,}}(?:{_DIGIT_WORD}|[0-9]+)(?!\w)", re.I)
_SPELLED_PART = re.compile(rf"(?<!\w)(plus|{_DIGIT_WORD}|dot|punkt|point|punto)(?!\w)", re.I)
_SPACED = re.compile(r"(?<=[A-Za-z0-9])[ \t]+@[ \t]*(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@[ \t]+(?=[A-Za-z0-9])")
#: One look at the text tells whether any transducer has work.
_HINT = re.compile(rf"{_ODD.pattern}|[(\[{{<][ \t]*(?:{_SIGN}|@|\.)[ \t]*[)\]}}>]|[ \t](?:at|arobase|arroba)[ \t]+[A-Za-z0-9-]+(?:[ \t.]+[A-Za-z0-9-]+){{0,4}}[ \t]+(?:dot|punkt|point|punto)[ \t]|(?<!\w)(?:{_DIGIT_WORD}){_GAP}(?:{_DIGIT_WORD}|[0-9])|[0-9]{_GAP}(?:{_DIGIT_WORD})(?!\w)|(?<!\w)(?:[0-9]+|{_DIGIT_WORD})[ \t]+(?:{_DOT})[ \t]+(?:{_DIGIT_WORD}|[0-9])|(?<!\w)plus[ \t]+(?:{_DIGIT_WORD}|[0-9])|[ \t]@|@[ \t]", re.I)


class Mapped:
    """A text on its way through the transducers: every character knows the source characters it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, list(range(len(text))), list(range(1, len(text) + 1))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put texts in place of ranges (ascending, apart). A replacement stands for its whole range."""
        if not edits:
            return
        parts, start, end, at = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            start += self.start[at:a] + [self.start[a]] * len(new)
            end += self.end[at:a] + [self.end[b - 1]] * len(new)
            at = b
        self.text = "".join([*parts, self.text[at:]])
        self.start, self.end = start + self.start[at:], end + self.end[at:]

    def source(self, span: Span) -> Span:
        """The span in the source text."""
        return Span(span.kind, self.start[span.start], self.end[span.end - 1])


def _glyphs(m: Mapped) -> None:
    m.replace([(x.start(), x.end(), _GLYPHS.get(ord(x[0]), "")) for x in _ODD.finditer(m.text)])


def _digits(m: Mapped) -> None:
    edits = []
    for run in _SPELLED.finditer(m.text):
        words = [x for x in _SPELLED_PART.finditer(m.text, run.start(), run.end())]
        if sum(x[0].lower() in DIGITS for x in words) < 3 and all(x[0].lower() in DIGITS for x in words):
            continue
        at, new, dotted = run.start(), [], False
        for x in words:
            between = m.text[at : x.start()]
            new.append(between if dotted or re.search(r"[0-9.,+-]", between) else "")
            word = x[0].lower()
            dotted = False
            if word in DIGITS:
                new.append(DIGITS[word])
            else:
                new.append("+" if word.startswith("plus") else ".")
            at = x.end()
        new.append(m.text[at : run.end()])
        joined = re.sub(r"(?<=[0-9])[ \t]*[,][ \t]*(?=[0-9])", "", "".join(new))
        joined = re.sub(r"\+[ \t]+(?=[0-9])", "+", re.sub(r"[ \t]*\.[ \t]*", ".", joined))
        edits.append((run.start(), run.end(), joined))
    m.replace(edits)


def _brackets(m: Mapped) -> None:
    edits, last = [], 0
    for x in _BRACKET.finditer(m.text):
        said, start = next(g for g in x.groups() if g), x.start()
        while start > last and m.text[start - 1] in " \t":
            start -= 1
        edits.append((start, x.end(), SIGNS.get(said.lower(), said)))
        last = x.end()
    m.replace(edits)


def _name_before(text: str, end: int, floor: int) -> int:
    """Start of the name that ends here: words with spoken dots between, back to ``floor`` at the most."""
    start = end
    while True:
        at = start
        while at > floor and text[at - 1] in _WORD:
            at -= 1
        if at == start:
            return end
        end = start = at
        while at > floor and text[at - 1] in " \t":
            at -= 1
        word = at
        while word > floor and start - word < 16 and text[word - 1].isalpha():
            word -= 1
        if at == start or text[word:at].lower() not in _DOTS or word == floor or text[word - 1] not in " \t":
            return end
        start = word
        while start > floor and text[start - 1] in " \t":
            start -= 1


def _spoken(m: Mapped) -> None:
    edits, last, at = [], 0, 0
    while x := _SPOKEN_AT.search(m.text, at):
        host = _SPOKEN_HOST.match(m.text, x.end())
        # what was looked at in vain holds no other sign, except as the word right behind this one
        at = host.end() if host else x.end() - 1
        if host:
            start = _name_before(m.text, x.start(), last)
            edits += [(w.start(), w.end(), SIGNS[w[1].lower()]) for w in _WORD_SIGN.finditer(m.text, start, host.end())]
            last = host.end()
    m.replace(edits)
    edits = []
    for x in _AFTER_AT.finditer(m.text):
        edits += [(w.start(), w.end(), ".") for w in _SPOKEN_DOT.finditer(m.text, x.start(), x.end())]
    m.replace(edits)


def _spaced(m: Mapped) -> None:
    m.replace([(x.start(), x.end(), "@") for x in _SPACED.finditer(m.text)])


#: Characters on either side of a hint that a find can reach.
REACH = 160


def _regions(text: str) -> list[tuple[int, int]]:
    """Stretches of the text around hints, merged where they touch and ending at white space."""
    out: list[list[int]] = []
    for x in _HINT.finditer(text):
        start, end = x.start() - REACH, x.end() + REACH
        floor = out[-1][1] if out else 0
        while start > floor and not text[start - 1].isspace():
            start -= 1
        if out and start <= floor:
            if end <= floor:
                continue
        else:
            out.append([max(0, start), 0])
        behind = _SPACE.search(text, min(end, len(text)))
        out[-1][1] = behind.start() if behind else len(text)
    return [(a, b) for a, b in out]


class _Placed:
    """Spans by kind, those of a kind in order and apart, to look up which of them a range touches."""

    def __init__(self, spans: list[Span]):
        self.spans = {k: sorted(s for s in spans if s.kind == k) for k in KINDS}
        self.ends = {k: [s.end for s in v] for k, v in self.spans.items()}

    def touched(self, start: int, end: int) -> list[Span]:
        out = []
        for kind, spans in self.spans.items():
            i = bisect_right(self.ends[kind], start)
            while i < len(spans) and spans[i].start < end:
                out.append(spans[i])
                i += 1
        return out


def hidden_spans(text: str, base: list[Span]) -> list[Span]:
    """What only the normalised text shows, in source characters. A find that touches a base span is left out,
    unless it holds every base span it touches, is of the kind of one of them and goes beyond them."""
    added: list[Span] = []
    placed, reached, refused = _Placed(base), dict.fromkeys(KINDS, 0), set()
    for a, b in _regions(text):
        m = Mapped(text[a:b])
        for step in (_glyphs, _digits, _brackets, _spoken, _spaced):
            step(m)
        for find in base_spans(m.text):
            if find.kind == "email" and not re.search(r"\.[A-Za-z]{2,}$", m.text[find.start : find.end]):
                continue
            s, e = m.source(find).start + a, m.source(find).end + a
            # finds of a kind come in order, so only the last one can be touched
            if s < reached[find.kind] or (find.kind, s, e) in refused:
                continue
            touched = placed.touched(s, e)
            longer = any(x.kind == find.kind for x in touched) and all(s <= x.start and x.end <= e and (s, e) != (x.start, x.end) for x in touched)
            if touched and not longer:
                refused.add((find.kind, s, e))  # many finds of a rewritten run stand for all of it
                continue
            reached[find.kind] = e
            added.append(Span(find.kind, s, e))
    return added


def find_personal(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a whole text, each by kind and start."""
    base = base_spans(text)
    order = lambda s: (KINDS.index(s.kind), s.start, s.end)
    return sorted(base, key=order), sorted({*base, *hidden_spans(text, base)}, key=order)


def joined(spans: list[Span]) -> str:
    """``kind:start:end`` joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """Every document without its text, with base counts ``n_email, n_ip, n_card, n_phone``, ``base_sha256``
    and ``spans``, all finds as ``kind:start:end``.

    Base finds follow the plain patterns on the whole text. Around hints (look-alike letters, characters that
    show nothing, spelled digits, bracketed or spoken signs) transducers rewrite the text while each character
    keeps its source range; the same patterns then run on the rewritten text and their finds are mapped back.
    A find that touches a base find is left out unless it extends one of its kind. Null and empty texts have no finds; repeated rows
    get the same result; columns of the result's names are replaced, other columns stay.
    """
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    docs = without(docs, names)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    types += ", n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, every = find_personal(text or "")
                counts = [sum(s.kind == k for s in base) for k in KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            kept = [n for n in batch.schema.names if n != "text"]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *made], [*kept, *names])

    return docs.mapInArrow(run, types)
