"""Personal data in texts, also where it is disguised.

Base detectors find e-mail addresses, IP addresses, card and phone numbers as
they stand. For disguises, transducers rewrite the text: look-alike characters
to ASCII, invisible characters to nothing, spelled digits to digits, and
written-out "at" and "dot" to @ and full stops, in addresses and between digits.
Spelled digits are read in two ways: long runs of single digits as one number,
and any spelled digit beside other digits, whose groups stay as they are. Every
piece of a rewritten text keeps the source offsets it comes from. The same detectors run on the
rewritten text, and what they find there is mapped back to source offsets. It
is added where a rewritten or left-out piece takes part and no span of that kind
covers it; it may overlap a base span, which stays.

A null text counts as empty and has no spans. Offsets are code points, ends
exclusive.
"""

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from broadsheet.llm.common import map_rows

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

# What the base detectors match.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, without overlap.

    A local part has no @, so a match is found from its @: the domain after it,
    and the run of local characters before it, back to the last match.
    """
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at)):
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    """Whether the last digit is right for the others."""
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(2 * int(d) - 9 * (int(d) > 4) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


DETECTORS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails, "ip": ips, "card": cards, "phone": phones,
}


def base_spans(text: str) -> list[Span]:
    """All base spans, by start and then kind as listed."""
    found = [(a, b, kind) for kind, detect in DETECTORS.items() for a, b in detect(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


# ---- rewriting -------------------------------------------------------------

# Letters of other scripts that look like ASCII ones.
_LOOKALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "·": ".",
}
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_DIGIT_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
_VALUES = {word: str(i) for i, word in enumerate(_DIGIT_WORDS)} | {"oh": "0"}
_SPELLED = "|".join(_VALUES)
_GAP = r"[\s.,-]{1,3}"
#: seven or more digits in a row, at least one of them spelled out
_DIGIT_RUN = re.compile(
    rf"(?<![A-Za-z0-9])(?:plus{_GAP}|\+\s?)?(?:(?:{_SPELLED})|[0-9])(?:{_GAP}(?:(?:{_SPELLED})|[0-9])){{6,}}(?![A-Za-z0-9])",
    re.I,
)
_BRACKETED_DOT = r"\s*+[\[({<]\s*+(?:dot|\.)\s*+[\])}>]\s*+"
_WRITTEN_DOT = rf"(?:{_BRACKETED_DOT}|\s++dot\s++)"
_WIDE_GAP = rf"(?:{_WRITTEN_DOT}|[\s.,-]++)"
#: a spelled digit beside another digit
_TWO_DIGITS = re.compile(rf"\b(?:{_SPELLED}){_WIDE_GAP}(?:[0-9]|(?:{_SPELLED})\b)|[0-9]{_WIDE_GAP}(?:{_SPELLED})\b")
#: digits, spelled or not, with what may stand between them; those beside an @ are part of an address
_DIGITS = rf"(?:{_SPELLED}|[0-9]++)(?![A-Za-z0-9@])"
_MIXED_RUN = re.compile(rf"(?<![A-Za-z0-9@])(?:plus[\s.,-]++)?{_DIGITS}(?:{_WIDE_GAP}{_DIGITS})++", re.I)
_MIXED_TOKEN = re.compile(rf"plus|{_SPELLED}|[0-9]++", re.I)
_DOT_IN_DIGITS = re.compile(rf"(?<=[0-9]){_WRITTEN_DOT}(?=[0-9])", re.I)
_DIGIT_TOKEN = re.compile(rf"plus|{_SPELLED}|[0-9]|\+", re.I)
_NAME = r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?"  # a local part has 64 characters at most, a label 63
_LABEL = r"[A-Za-z0-9-]{1,63}"
_AT = r"(?:\s*+[\[({<]\s*+(?:at|@)\s*+[\])}>]\s*+|\s++(?:at|@)\s++)"
_DOT = rf"(?:{_WRITTEN_DOT}|\.)"
#: name, at, labels with dots; an "at" in words needs a written dot; 64 characters hold 32 names at most
_ADDRESS = re.compile(rf"(?<![A-Za-z0-9._%+@-])({_NAME}(?:{_WRITTEN_DOT}{_NAME}){{0,31}})({_AT}|@)({_LABEL}(?:{_DOT}{_LABEL}){{1,8}})", re.I)
_AT_TRIGGER = re.compile(r"\bdot\b|[\[({<]\s*+(?:at|@|\.)\s*+[\])}>]|\s@\s", re.I)
_DOT_ONLY = re.compile(_DOT, re.I)
_DOT_WRITTEN = re.compile(r"\bdot\b|[\[({<]", re.I)
_IN_WORDS = re.compile(r"\s*at\s*", re.I)


class Rewritten:
    """A text with the source offsets of its pieces."""

    def __init__(self, text: str):
        self.text = text
        self.starts = [0]  # of pieces in the text
        self.source = [(0, len(text), False)]  # where each comes from, and whether it was changed

    @classmethod
    def of(cls, pieces: list[tuple[str, int, int, bool]]) -> "Rewritten":
        """From (new text, source start, source end, changed)."""
        self = cls.__new__(cls)
        self.text = "".join(p[0] for p in pieces)
        self.starts, self.source, at = [], [], 0
        for new, start, end, changed in pieces:
            if new:
                self.starts.append(at)
                self.source.append((start, end, changed))
                at += len(new)
        return self

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of text[start:end], and whether a changed or left-out piece takes part."""
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        a, a_end, a_changed = self.source[first]
        b, b_end, b_changed = self.source[last]
        if not a_changed:
            a += start - self.starts[first]
        to = b_end if b_changed else b + (end - self.starts[last])
        taken = self.source[first : last + 1]
        left_out = any(one[1] < two[0] for one, two in zip(taken, taken[1:]))
        return a, to, left_out or any(c for _, _, c in taken)

    def replaced(self, changes: list[tuple[int, int, str]]) -> "Rewritten":
        """With the spans of ``changes`` (in order, of the present text) replaced."""
        pieces: list[tuple[str, int, int, bool]] = []
        at = 0

        def keep(until: int) -> None:
            nonlocal at
            while at < until:
                nth = bisect_right(self.starts, at) - 1
                stop = self.starts[nth + 1] if nth + 1 < len(self.starts) else len(self.text)
                stop = min(stop, until)
                a, b, changed = self.back(at, stop)
                pieces.append((self.text[at:stop], a, b, changed))
                at = stop

        for start, end, new in changes:
            keep(start)
            a, b, _ = self.back(start, end)
            pieces.append((new, a, b, True))
            at = end
        keep(len(self.text))
        return Rewritten.of(pieces)


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    """Characters that stand for ASCII ones, or for nothing.

    Letters of other scripts count only in a word that also has ASCII letters,
    digits or an @, so that words of those scripts stay.
    """
    changes = []
    if text.isascii() or not _WIDE.search(text):
        return changes
    for m in re.finditer(r"\S+", text):
        if m[0].isascii() or not _WIDE.search(m[0]):
            continue
        mixed = any(c.isascii() and c.isalnum() or c == "@" for c in unicodedata.normalize("NFKC", m[0]))
        for at, c in enumerate(m[0], m.start()):
            if c.isascii():
                continue
            if c in _INVISIBLE:
                changes.append((at, at + 1, ""))
            elif len(plain := unicodedata.normalize("NFKC", c)) == 1 and plain.isascii():
                changes.append((at, at + 1, plain))
            elif mixed and (plain := _LOOKALIKES.get(c)):
                changes.append((at, at + 1, plain))
    return changes


_WIDE = re.compile(r"[^\x00-\xff]|[\xad\xb2\xb3\xb7\xb9]")


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    changes = []
    lower = text.lower()
    if not any(word in lower for word in _VALUES) or not _TWO_DIGITS.search(lower):
        return changes
    for m in _DIGIT_RUN.finditer(text):
        tokens = [t.lower() for t in _DIGIT_TOKEN.findall(m[0])]
        if any(t in _VALUES for t in tokens):
            new = "".join("+" if t in ("plus", "+") else _VALUES.get(t, t) for t in tokens)
            changes.append((m.start(), m.end(), new))
    return changes


def mixed_digits(text: str) -> list[tuple[int, int, str]]:
    """Any spelled digit beside other digits, spelled or not.

    Between single digits, one of them spelled, nothing is left; full stops and
    what stands beside groups of digits stay, wider white space as one space.
    """
    changes = []
    lower = text.lower()
    if not any(word in lower for word in _VALUES) or not _TWO_DIGITS.search(lower):
        return changes
    for m in _MIXED_RUN.finditer(text):
        tokens = [(t[0].lower(), *t.span()) for t in _MIXED_TOKEN.finditer(text, m.start(), m.end())]
        if not any(t in _VALUES for t, _, _ in tokens):
            continue
        before, done = "", m.start()
        for token, start, end in tokens:
            gap = text[done:start]
            if before == "plus":
                changes.append((done, start, ""))
            elif gap and not gap.strip(" \t\n\r\f\v,-") and (before in _VALUES or token in _VALUES):
                if all(len(t) == 1 or t in _VALUES for t in (before, token)):
                    changes.append((done, start, ""))
                elif len(gap) > 1 and gap.isspace():
                    changes.append((done, start, " "))
            if token == "plus" or token in _VALUES:
                changes.append((start, end, "+" if token == "plus" else _VALUES[token]))
            before, done = token, end
    return changes


def dots_in_digits(text: str) -> list[tuple[int, int, str]]:
    """Written dots between digits."""
    if not ("dot" in text.lower() or any(c in text for c in "[({<")):
        return []
    return [(*m.span(), ".") for m in _DOT_IN_DIGITS.finditer(text)]


def written_addresses(text: str) -> list[tuple[int, int, str]]:
    changes = []
    if not ("dot" in text.lower() or "@" in text or any(c in text for c in "[({<")) or not _AT_TRIGGER.search(text):
        return changes
    for m in _ADDRESS.finditer(text):
        name, at, domain = m.groups()
        if m[0] == f"{name}@{domain}" and not re.search(r"[\s\[({<]", m[0]):
            continue  # not disguised
        if _IN_WORDS.fullmatch(at) and not _DOT_WRITTEN.search(domain):
            continue  # prose
        # a full stop at the end of a sentence is no part of a domain
        new = _DOT_ONLY.sub(".", name) + "@" + _DOT_ONLY.sub(".", domain)
        changes.append((m.start(), m.end(), new))
    return changes


def rewritten(text: str) -> Iterator[Rewritten]:
    """The text without disguises, once for each way to read spelled digits; nothing if it has none."""
    known = {text}
    for digits in (spelled_digits, mixed_digits):
        out = None
        for find in (look_alikes, digits, written_addresses, dots_in_digits):
            if changes := find(out.text if out else text):
                out = (out or Rewritten(text)).replaced(changes)
        # only characters are left out or replaced, in the same places if the texts are equal
        if out and out.text not in known:
            known.add(out.text)
            yield out


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows."""
    found: dict[str, set[tuple[int, int]]] = {}
    for plain in rewritten(text):
        for kind, detect in DETECTORS.items():
            for start, end in detect(plain.text):
                a, b, changed = plain.back(start, end)
                if changed:
                    found.setdefault(kind, set()).add((a, b))
    return [
        (a, b, kind)
        for kind, spans in found.items()
        for a, b in uncovered(spans, [(a, b) for a, b, k in base if k == kind])
    ]


def uncovered(found: set[tuple[int, int]], base: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The spans found that no base span and no other one found covers, by start."""
    reach = 0
    for a, b, own in sorted([(*s, False) for s in base] + [(*s, True) for s in found], key=lambda s: (s[0], -s[1], s[2])):
        if own and b > reach:
            yield a, b
        reach = max(reach, b)


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the text's base spans and all its spans, as kind, start and end."""

    def row(doc_id, text):
        base = base_spans(text or "")
        spans = sorted(base + added_spans(text or "", base), key=_order)
        yield doc_id, [_item(s) for s in base], [_item(s) for s in spans]

    item = "array<struct<kind: string, start: long, end: long>>"
    return map_rows(docs.select("doc_id", "text"), f"doc_id long, base {item}, spans {item}", row)


def _item(span: Span) -> dict:
    return {"kind": span[2], "start": span[0], "end": span[1]}


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, SHA-256 of the base spans, all spans as text."""

    def row(doc_id, text):
        base = base_spans(text or "")
        added = added_spans(text or "", base)
        counts = [sum(k == kind for _, _, k in base) for kind in KINDS]
        spans = as_text(sorted(base + added, key=_order))
        yield doc_id, *counts, hashlib.sha256(as_text(base).encode()).hexdigest(), spans, len(added)

    return map_rows(
        docs.select("doc_id", "text"),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
        " spans string, n_added long",
        row,
    )
