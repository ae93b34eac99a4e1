"""Personal data in texts (operator 5).

Regular expressions propose spans, validators confirm them (Luhn for card
numbers, mod-97 for IBANs, ranges for addresses and numbers), and words near a
span move its score.  Emails, IP addresses, card and phone numbers that pass
their validator are always reported; IBANs, social security numbers and local
phone numbers are added when their score reaches ``LEAST``: an IBAN's checksum
is enough, the other two need a word that announces them.  An added span that
overlaps an earlier reported one is left out.

Patterns are matched leftmost and without overlap within a kind; a match that
fails its validator is dropped without a second try.  Each scan is linear in
the length of the text.

Defined cases: null text is empty; texts are searched whole; positions are code
points, the end exclusive; a null ``doc_id`` and repeated rows are returned as
they are; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract of the query: kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match inside a run of digits would have matched at its start already
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Added kinds: pattern, score without context, words that announce the kind.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "local_phone": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "payment", "credit"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto"),
    "ssn": ("ssn", "social security"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax"),
}
#: Words that make a span less likely: versions, examples, serial numbers.
AGAINST = ("version", "serial", "build", "isbn", "order")
NEAR = 40
LEAST = 0.5


def octet(part: str) -> bool:
    """Whether the value is at most 255, whatever the leading zeros."""
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the e-mail pattern: from each @ back over the local part."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four base kinds that pass their validators."""
    out = [(a, b, "email") for a, b in emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(octet(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def score(text: str, start: int, end: int, kind: str) -> float:
    """Base score of the kind, moved by the words around the span."""
    near = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR // 2]}".lower()
    value = BASE_SCORE[kind]
    if any(re.search(rf"\b{w}", near) for w in CONTEXT[kind]):
        value += 0.3
    if any(re.search(rf"\b{w}\b", near) for w in AGAINST):
        value -= 0.3
    return round(min(max(value, 0.0), 1.0), 2)


def added_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
    """Spans of the further kinds that score ``LEAST`` and overlap no other."""
    found = [(m.start(), m.end(), "iban") for m in IBAN.finditer(text) if mod97(m[0].replace(" ", ""))]
    found += [(m.start(), m.end(), "ssn") for m in SSN.finditer(text)
              if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000"]
    found += [(m.start(), m.end(), "local_phone") for m in LOCAL_PHONE.finditer(text)]
    if not found:
        return []
    # longest end of the base spans up to each start: overlaps are found by search
    taken = sorted((a, b) for a, b, _ in base)
    starts = [a for a, _ in taken]
    reach = list(accumulate((b for _, b in taken), max))
    out: list[tuple[int, int, str, float]] = []
    kept: list[tuple[int, int]] = []  # disjoint, by start
    for a, b, kind in found:
        value = score(text, a, b, kind)
        i, j = bisect_left(starts, b), bisect_left(kept, (b, 0))
        if value >= LEAST and not (i and reach[i - 1] > a) and not (j and kept[j - 1][1] > a):
            out.append((a, b, kind, value))
            insort(kept, (a, b))
    return out


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    order = {k: i for i, k in enumerate(BASE_SCORE)}
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())]))
    for batch in batches:
        rows = []
        for text in batch["text"].to_pylist():
            text = text or ""
            base = base_spans(text)
            spans = [(a, b, k, score(text, a, b, k), True) for a, b, k in base]
            spans += [(*s, False) for s in added_spans(text, base)]
            spans.sort(key=lambda s: (s[0], order[s[2]]))
            rows.append([{"kind": k, "start": a, "end": b, "score": v, "base": f} for a, b, k, v, f in spans])
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, kind)], names=["doc_id", "spans"])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id and spans, an array of (kind, start, end, score,
    base) by start, then kind."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(_find, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, "
                          "spans array<struct<kind: string, start: int, end: int, score: double, base: boolean>>")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: counts, a hash of the base spans, all spans and
    their scores in the same order."""
    def joined(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"

    base = "filter(spans, s -> s.base)"
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(joined(base)), 256).alias("base_sha256"), F.expr(joined("spans")).alias("spans"),
                        F.expr("array_join(transform(spans, s -> CAST(s.score AS STRING)), ',')").alias("scores"))
