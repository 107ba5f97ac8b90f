"""Personal data: patterns propose spans, checksums confirm them, and words nearby move the score."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "short_card", "national_phone")
KINDS = BASE_KINDS + ADDED_KINDS
#: An added span needs this score. Base spans are kept whatever their score.
LEAST_SCORE = 0.6
NEAR = 40

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No digit may stand before an address: a run of digits that fails as a whole fails from any of its digits.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{3,4})[ .-][0-9]{3}[ .-][0-9]{3,4}(?![0-9])")

#: Words that speak for a kind when they stand near a span. Fixed values.
CONTEXT = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "fax"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "short_card": ("card", "visa", "credit", "amex", "karte", "tarjeta", "carte"),
    "national_phone": ("phone", "tel", "call", "mobile", "telefon", "fax"),
}
#: Score of a confirmed span before words nearby are read.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.75, "short_card": 0.4, "national_phone": 0.35}
CONTEXT_GAIN = 0.3
_WORD = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the last digit is right by the Luhn rule."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if i % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without blanks leaves 1 after division by 97, its first four signs put last."""
    rest = 0
    for sign in account[4:] + account[:4]:
        value = int(sign, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is looked at once, so a long run of letters costs nothing."""
    floor, at = 0, text.find("@")
    while at >= 0:
        following = at + 1
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at)):
            yield start, found.end()
            floor = following = found.end()
        at = text.find("@", following)


def _digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans that the contract fixes, in order of kind and start."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    cards = ((m.span(), _digits_of(m[0])) for m in _DIGITS.finditer(text) if m.end() - m.start() > 15)
    found += [("card", *s) for s, d in cards if 16 <= len(d) <= 19 and luhn(d)]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits_of(m[0])) <= 15] if "+" in text else []
    return found


def _account_end(found: str) -> int:
    """Where the longest account number ends that starts `found` and stops at a blank or at its end; 0 if there is none."""
    end = len(found)
    while end > 0:
        account = found[:end].replace(" ", "")
        if 15 <= len(account) <= 34 and mod97(account):
            return end
        end = found.rfind(" ", 0, end)
    return 0


def _added(text: str) -> Iterator[tuple[str, int, int]]:
    at = 0
    while m := _IBAN.search(text, at):
        end = _account_end(m[0])
        if end:
            yield "iban", m.start(), m.start() + end
        at = m.start() + (end or 1)
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() > 12 and 13 <= len(d := _digits_of(m[0])) <= 15 and luhn(d):
            yield "short_card", *m.span()
    for m in _NATIONAL.finditer(text):
        yield "national_phone", *m.span()


def _score(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - NEAR):start] + " " + text[end:end + NEAR]
    speaks = not set(CONTEXT[kind]).isdisjoint(w.lower() for w in _WORD.findall(around))
    return min(1.0, PRIOR[kind] + CONTEXT_GAIN * speaks)


def spans_of(text: str) -> list[Span]:
    """All spans in order of kind and start. An added span must reach the least score and touch no earlier kind."""
    base = base_spans(text)
    spans = [Span(*s, _score(text, *s)) for s in base]
    if any("0" <= c <= "9" for c in text) if len(text) < 256 else re.search("[0-9]", text):
        starts, ends = _apart((a, b) for _, a, b in base)
        # The spans of one added kind do not touch each other, so each kind is held against the earlier ones as a whole.
        for _, own in groupby(_added(text), key=itemgetter(0)):
            fresh = []
            for kind, start, end in own:
                before = bisect_left(starts, end)
                if (not before or ends[before - 1] <= start) and (score := _score(text, kind, start, end)) >= LEAST_SCORE:
                    fresh.append(Span(kind, start, end, score))
            spans += fresh
            starts, ends = _apart([*zip(starts, ends, strict=True), *((s.start, s.end) for s in fresh)])
    return spans


def _apart(spans) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, in order; those that overlap become one."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def joined(spans: list) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, base_sha256, spans, and scores (one for each span, comma-joined).

    Offsets count code points. A null text is empty: no spans, the hash of no bytes. Rows are independent, so repeated ids,
    null ids and extra columns change nothing; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            digests, texts, scores = [], [], []
            for value in batch.column(1).to_pylist():
                spans = spans_of(value or "")
                base = [s for s in spans if s.kind in BASE_KINDS]
                for n, name in zip(counts, BASE_KINDS, strict=True):
                    n.append(sum(s.kind == name for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                texts.append(joined(spans))
                scores.append(",".join(f"{s.score:.2f}" for s in spans))
            arrays = [batch.column(0), *(pa.array(n, pa.int64()) for n in counts),
                      *(pa.array(x, pa.string()) for x in (digests, texts, scores))]
            yield pa.RecordBatch.from_arrays(
                arrays, ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "scores"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in BASE_KINDS)
                           + ", base_sha256 string, spans string, scores string")


def redact(text: str) -> str:
    """The text with a tag in the place of each span; of overlapping spans, the one that starts first."""
    out, at = [], 0
    for span in sorted(spans_of(text), key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            out += [text[at:span.start], f"<{span.kind}>"]
            at = span.end
    return "".join([*out, text[at:]])
