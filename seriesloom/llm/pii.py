"""Personal data in texts, with deobfuscation that keeps the source offsets.

Base spans come from four fixed patterns over the text itself.  A chain of
transducers then rewrites disguises (homoglyphs and full-width characters,
zero-width characters, spelled digits, "at"/"dot" words and brackets) while
recording which source characters each rewritten piece stands for; the same
patterns run over the rewritten text, and what they find is mapped back.  Such
a span is added unless it overlaps a base span; base spans always stay.

Offsets count code points, ends are exclusive.  A null text counts as empty
and has no spans; so has an empty table no rows.  Repeated rows are answered
one by one.  All scanning is linear in the length of the text, so very long
texts are taken whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import slices

#: The order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

# Each of these matches the same spans as the plain pattern of its kind, in
# linear time: runs are possessive, and a match starts only where a run starts,
# since a later start in the same run has the same continuation.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LONG_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9]){15}")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def find_base(text: str) -> list[Span]:
    """The spans of the four fixed patterns, by kind as listed, then start."""
    spans = list(_emails(text)) if "@" in text else []
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in m.groups())]
    if _LONG_DIGITS.search(text):
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return spans


# --- disguises: fixed tables -------------------------------------------------

#: Letters of other scripts that look like Latin ones (fixed values).
HOMOGLYPHS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "ı": "i", "ⅼ": "l", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-",
    " ": " ", " ": " ", " ": " ", " ": " ", "﹫": "@",
}
#: Full-width ASCII, and the decimal digits of other scripts by the first of each ten (fixed values).
_ONE_TO_ONE = {ord(k): v for k, v in HOMOGLYPHS.items()}
_ONE_TO_ONE |= {0xFF01 + k: chr(0x21 + k) for k in range(94)}
_ONE_TO_ONE |= {zero + k: str(k) for zero in (0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50) for k in range(10)}
#: Characters without width, dropped (fixed values).
_INVISIBLE = "​‌‍⁠﻿­"
#: Digits as words (fixed values).
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}

_SUSPECT = re.compile("[" + re.escape("".join(map(chr, _ONE_TO_ONE))) + _INVISIBLE + "]")
_DROPPED = re.compile(f"[{_INVISIBLE}]+")
_WORD = "|".join(DIGIT_WORDS)
# Three digit words or more in a row, with "plus", "dash" or "dot" among them: fewer are ordinary words.
_SPELLED = re.compile(rf"(?i)(?<![A-Za-z])(?:plus[\s-]++)?(?:{_WORD})(?:[\s,.-]*+(?:(?:dot|point|dash)[\s-]++)?(?:{_WORD}|[0-9]++)(?![A-Za-z])){{2,}}")
_SPELLED_PART = re.compile(rf"(?i){_WORD}|plus|dot|point|dash|[0-9]+|[\s,.-]+")
_HINT_SPELLED = re.compile(rf"(?i)\b(?:{_WORD})\b")
# What may stand for an at sign or a dot: in brackets (strong), as a word or set apart by blanks (weak), or the plain sign.
_SIGN = re.compile(
    r"(?i)(?P<strong_at>\s{0,3}[\[({<]\s{0,3}(?:at|@)\s{0,3}[\])}>]\s{0,3})|(?P<strong_dot>\s{0,3}[\[({<]\s{0,3}(?:dot|\.)\s{0,3}[\])}>]\s{0,3})"
    r"|(?P<weak_at>\s{1,3}(?:at|@)\s{1,3}|\s{1,3}@|@\s{1,3}|[_-]at[_-])|(?P<weak_dot>\s{1,3}(?:dot|punkt|punto|point)\s{1,3}|[_-]dot[_-])"
    r"|(?P<plain_at>@)|(?P<plain_dot>\.)"
)
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_HINT_DISGUISED = re.compile(r"(?i)[\[({<]\s{0,3}(?:at|@|dot|\.)\s{0,3}[\])}>]|[\s_-](?:dot|punkt|punto|point)[\s_-]|\s@|@\s")
#: Top-level domains that words alone are taken for an address with; brackets need none (fixed values).
DOMAINS = frozenset("com org net edu gov mil int info biz io co ai app dev me tv eu uk us ca au de fr es it nl be ch at pl pt se no fi dk ie cz ru ua in jp cn br mx ar cl nz za".split())


class Rewritten:
    """A text together with the source characters that each part of it stands for."""

    def __init__(self, text: str):
        self.text = text
        #: Starts in the rewritten text and, for each part, (source start, source end, copied one to one).
        self._starts = [0]
        self._parts = [(0, len(text), True)]

    def replaced(self, edits: list[tuple[int, int, str]]) -> Rewritten:
        """A new text where each (start, end, new) of this one's offsets is exchanged; edits come sorted and apart."""
        if not edits:
            return self
        out, new, starts, parts, at, n = Rewritten(""), [], [], [], 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal n
            k = bisect_right(self._starts, a) - 1
            while a < b:
                stop = min(b, self._starts[k + 1]) if k + 1 < len(self._starts) else b
                s, e, same = self._parts[k]
                starts.append(n)
                parts.append((s + a - self._starts[k], s + stop - self._starts[k], True) if same else (s, e, False))
                new.append(self.text[a:stop])
                n += stop - a
                a, k = stop, k + 1

        for start, end, by in edits:
            copy(at, start)
            if by:
                starts.append(n)
                parts.append((*self.source(start, end), False))
                new.append(by)
                n += len(by)
            at = end
        copy(at, len(self.text))
        out.text, out._starts, out._parts = "".join(new), starts or [0], parts or [(0, 0, True)]
        return out

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of a span of this text."""
        if start >= end:
            return 0, 0
        a, b = bisect_right(self._starts, start) - 1, bisect_right(self._starts, end - 1) - 1
        s, _, same = self._parts[a]
        t, u, same_end = self._parts[b]
        return s + (start - self._starts[a] if same else 0), (t + end - self._starts[b] if same_end else u)


def _spelled(match: re.Match) -> str:
    """Digits and signs of a run of digit words."""
    out = []
    for m in _SPELLED_PART.finditer(match[0]):
        part = m[0].lower()
        if part in DIGIT_WORDS:
            out.append(DIGIT_WORDS[part])
        elif part[0].isdigit():
            out.append(part)
        else:
            out.append({"plus": "+", "dot": ".", "point": ".", "dash": "-"}.get(part, ""))
    return "".join(out)


def _start(signs: list[tuple[int, int, str, str]], k: int, text: str) -> int:
    return signs[k][0] if k < len(signs) else len(text)


def _signs(text: str) -> list[tuple[int, int, str]]:
    """Edits that write disguised signs plainly: in addresses, and dots between digits.

    One pass over the signs.  An address is an at sign followed by labels with
    dots between, and some sign of it is disguised.  Without a bracket among
    its signs it must end in a known domain; it goes as far as one does.
    """
    signs = [(m.start(), m.end(), *m.lastgroup.split("_")) for m in _SIGN.finditer(text)]
    edits, k = [], 0
    while k < len(signs):
        start, end, strength, sign = signs[k]
        k += 1
        if sign == "dot":
            if strength != "plain" and start and end < len(text) and text[start - 1] in "0123456789" and text[end] in "0123456789":
                edits.append((start, end, "."))
            continue
        if not start or text[start - 1] not in _LOCAL:
            continue
        # The word "at" before a plain host name is ordinary text.
        bracket, dots, found = strength == "strong", [], 0
        hidden = bracket or (strength == "weak" and "@" in text[start:end])
        label = _LABEL.fullmatch(text, end, _start(signs, k, text))
        while label and k + len(dots) < len(signs):
            s, e, how, what = signs[k + len(dots)]
            label = _LABEL.match(text, e, _start(signs, k + len(dots) + 1, text))
            if what != "dot" or not label:
                break
            dots.append((s, e))
            bracket, hidden = bracket or how == "strong", hidden or how != "plain"
            if hidden and (bracket or label[0].lower() in DOMAINS):
                found = len(dots)
            if label.end() < _start(signs, k + len(dots), text):
                break
        if found:
            edits += [(start, end, "@"), *((s, e, ".") for s, e in dots[:found])]
            k += found
    return edits


def deobfuscate(text: str) -> Rewritten:
    """The transducers one after another: look-alikes, invisible characters, digit words, at/dot."""
    now = Rewritten(text)
    if not text.isascii() and _SUSPECT.search(text):
        now.text = text.translate(_ONE_TO_ONE)  # one to one: the offsets stay
        now = now.replaced([(m.start(), m.end(), "") for m in _DROPPED.finditer(now.text)])
    if _HINT_SPELLED.search(now.text):
        now = now.replaced([(m.start(), m.end(), _spelled(m)) for m in _SPELLED.finditer(now.text)])
    if _HINT_DISGUISED.search(now.text):
        now = now.replaced(_signs(now.text))
    return now


def find_all(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans together with those found behind disguises, both in the listed order."""
    base = find_base(text)
    plain = deobfuscate(text)
    if plain.text == text:
        return base, base
    taken = sorted((s, e) for _, s, e in base)
    furthest = list(accumulate((e for _, e in taken), max))
    added = []
    for kind, start, end in find_base(plain.text):
        s, e = plain.source(start, end)
        k = bisect_left(taken, (e, -1))
        if not (k and furthest[k - 1] > s):
            added.append((kind, s, e))
    return base, sorted({*base, *added}, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in slices(batches):
        base, every = [], []
        for text in batch.column(1).to_pylist():
            found = find_all(text) if text else ([], [])
            for out, spans in zip((base, every), found, strict=True):
                out.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(every, pa.list_(span))], ["id", "base", "spans"])


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): the spans of every document, both arrays of (kind, start, end)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, f"id long, base {_SPANS}, spans {_SPANS}").withColumnRenamed("id", id_col)


def mask_text(text: str, spans: list[Span]) -> str:
    """The text with each span exchanged for its kind in angle brackets; of overlapping spans, the union is exchanged once."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _masked(names: list[str], at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t and mask_text(t, find_all(t)[1]) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def mask(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span exchanged for its kind; a null text stays null."""
    return docs.mapInArrow(_masked(docs.columns, docs.columns.index(text_col)), docs.schema)
