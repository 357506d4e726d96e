"""Personal data by offset-preserving deobfuscation.

Identifiers are looked for twice: in the text as it stands, and in the text as a reader takes it.
The second is written by small transducers that keep, for every character they put out, the
source span it stands for: look-alike letters become the letters they resemble, characters
without width vanish, runs of spelled digits become digits, and ``[at]``, ``(dot)`` and the like
become ``@`` and ``.``. What the detectors find there is mapped back to source characters, and
added unless it touches something found before.

Everything is a scan of one text at a time; rows are never brought together.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in their order among spans that start alike.
KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind: string, start: int, end: int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: what follows the run would be the same.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the whole run before an ``@``, so the runs are walked from there."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of each identifier, sorted."""
    found = [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


# Cyrillic and Greek letters and the Latin letters they look like.
_LOOK_ALIKE = dict(
    zip(
        "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅαορνικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijshdqwABEKMHOPCTYXIJSaopvikABEZHIKMNOPTYX",
        strict=True,
    )
)
_NO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_DIGIT_WORDS = {
    word: str(digit)
    for digit, word in enumerate("zero one two three four five six seven eight nine".split())
}
_SPELLED = "(?:" + "|".join(_DIGIT_WORDS) + ")"
#: Domain ends that a plain word "at" may lead to; brackets may lead to any.
_ENDS = "com|org|net|edu|gov|info|biz|io|co|uk|de|fr|es|eu|ru|cn|in"
_FOREIGN = re.compile(f"[\u0370-\u04ff\u0500-\u052f\uff01-\uff5e{_NO_WIDTH}]")
_BRACKETED = re.compile(r"\s?([\[({<])\s?(?:(at)|dot|punkt|punto|point)\s?([\])}>])\s?", re.I)
_PLAIN = re.compile(
    rf"(?<=[\w%+-]) at (?=[A-Za-z0-9-]+(?:(?:\.| dot )[A-Za-z0-9-]+)*(?:\.| dot )(?:{_ENDS})\b)", re.I
)
_PLAIN_DOT = re.compile(r"(?<=[A-Za-z0-9-]) dot (?=[A-Za-z0-9-])", re.I)
_PLAIN_REST = re.compile(rf"[A-Za-z0-9-]+(?:(?:\.| dot )[A-Za-z0-9-]+)*?(?:\.| dot )(?:{_ENDS})\b", re.I)
_DIGITS_SPELLED = re.compile(rf"(?i:\b{_SPELLED}(?:[ -]{_SPELLED})+\b)")


def _look_alike(char: str) -> str:
    """What one character reads as; one character, or none."""
    if char in _NO_WIDTH:
        return ""
    if "\uff01" <= char <= "\uff5e":
        return unicodedata.normalize("NFKC", char)
    return _LOOK_ALIKE.get(char, char)


class Readable:
    """A text in the making. ``starts`` and ``ends`` hold the source span of each character."""

    def __init__(self, text: str) -> None:
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)

    def replace(self, spans: list[tuple[int, int, str]]) -> None:
        """Put other characters in the place of spans of the text so far. Each of them stands
        for all that its span stood for."""
        text, starts, ends, at = [], [], [], 0
        for start, end, new in spans:
            text += [self.text[at:start], new]
            starts += [*self.starts[at:start], *[self.starts[start]] * len(new)]
            ends += [*self.ends[at:start], *[self.ends[end - 1]] * len(new)]
            at = end
        self.text = "".join([*text, self.text[at:]])
        self.starts, self.ends = [*starts, *self.starts[at:]], [*ends, *self.ends[at:]]


def readable(text: str) -> Readable | None:
    """The text without its disguises, or None where it has none."""
    out, changed = Readable(text), False

    def put(spans: list[tuple[int, int, str]]) -> None:
        nonlocal changed
        if spans:
            out.replace(spans)
            changed = True

    if not text.isascii():
        put([(m.start(), m.end(), _look_alike(m[0])) for m in _FOREIGN.finditer(text) if _look_alike(m[0]) != m[0]])
    if _BRACKETED.search(out.text):
        put([(m.start(), m.end(), "@" if m[2] else ".") for m in _BRACKETED.finditer(out.text)])
    # A plain "at" counts where a known domain end follows, with its dots spelled or not.
    spans = []
    for m in _PLAIN.finditer(out.text):
        spans.append((m.start(), m.end(), "@"))
        rest = _PLAIN_REST.match(out.text, m.end())
        spans += [(d.start(), d.end(), ".") for d in _PLAIN_DOT.finditer(out.text, m.end(), rest.end())]
    at = [p for p, c in enumerate(out.text) if c == "@"] if "@" in out.text and " dot " in out.text else []
    for p in at:  # the dots after a bracketed at
        rest = _PLAIN_REST.match(out.text, p + 1)
        if rest:
            spans += [(d.start(), d.end(), ".") for d in _PLAIN_DOT.finditer(out.text, p + 1, rest.end())]
    put(sorted(set(spans)))
    put(
        [
            (m.start(), m.end(), "".join(_DIGIT_WORDS[w] for w in re.split("[ -]", m[0].lower())))
            for m in _DIGITS_SPELLED.finditer(out.text)
        ]
    )
    return out if changed else None


def disguised(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Identifiers that show in the readable text only. One that touches a known span is left
    out; so every span added holds a disguise."""
    plain = readable(text)
    if plain is None:
        return []
    taken = sorted((s, e) for s, _, e in known)
    begins, latest = [s for s, _ in taken], list(accumulate((e for _, e in taken), max, initial=-1))
    added = []
    for start, kind, end in identifiers(plain.text):
        s, e = plain.starts[start], max(plain.ends[start:end])
        # None of the known spans that begin before its end may end after its start.
        if latest[bisect_left(begins, e)] <= s:
            added.append((s, kind, e))
    return sorted(set(added))


def found_in(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``, arrays of (kind, start, end) in code points, end
    exclusive, sorted by start and kind. NULL and empty texts have none. Columns of these names,
    other than the text, are replaced."""
    docs = docs.drop(*({"base", "added"} - {text}))
    if text in ("base", "added"):
        raise ValueError("the text must not be called base or added")
    place = docs.columns.index(text)

    def named(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, added = [], []
            for value in batch.iloc[:, place]:
                known = identifiers(value) if value else []
                base.append(named(known))
                added.append(named(disguised(value, known)) if value else [])
            yield batch.assign(base=base, added=added)

    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInPandas(find, f"{plain}, base {SPANS}, added {SPANS}")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each identifier, disguised or not, replaced by its kind in brackets."""
    place = docs.columns.index(text)
    schema = docs.schema

    def redact(value: str | None) -> str | None:
        if not value:
            return value
        known = identifiers(value)
        out, at = [], 0
        for start, kind, end in sorted(known + disguised(value, known)):
            if start >= at:
                out += [value[at:start], f"[{KINDS[kind]}]"]
            at = max(at, end)
        return "".join([*out, value[at:]])

    def replace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch.isetitem(place, [redact(value) for value in batch.iloc[:, place]])
            yield batch

    return docs.mapInPandas(replace, schema)


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Of each document the counts of its plain identifiers, and its spans."""
    order = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    # Sorted by start and kind by way of a number in front.
    by_place = f"transform(array_sort(transform(concat(base, added), x -> struct(x.start AS a, {order} AS b, x AS s))), y -> y.s)"
    return found_in(docs.select("doc_id", "text")).select(
        "doc_id",
        *[F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined(by_place).alias("spans"),
        F.size("added").cast("long").alias("n_disguised"),
    )
