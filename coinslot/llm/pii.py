"""Personal data: patterns propose spans, validators confirm them, nearby words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coinslot.llm.rows import filled, slices, text_bytes

#: Patterns of the base kinds. Possessive repeats and digit borders keep long runs linear; they match
#: the same spans as the plain patterns. Fixed values.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: Added kinds: account numbers (mod 97) and social security numbers (only with a context word).
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
#: Words that raise the score of a kind when they stand within NEAR characters.
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "credit", "visa"),
    "phone": ("phone", "call", "mobile", "fax"), "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social", "security"),
}
NEAR = 40
#: Score of a confirmed span, what a context word adds, and the least score of an added kind.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
BOOST, LEAST = 0.35, 0.5

SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def only_digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: the run of local characters before it, the domain after it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans in the order of the kinds, then of their start."""
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if 16 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
            yield "card", *m.span()
    for m in PHONE.finditer(text):
        if 8 <= len(only_digits(m[0])) <= 15:
            yield "phone", *m.span()
    for m in IBAN.finditer(text):
        plain = m[0].replace(" ", "")
        if 15 <= len(plain) <= 34 and mod97(plain):
            yield "iban", *m.span()
    for m in SSN.finditer(text):
        yield "ssn", *m.span()


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text with scores. Base kinds stay whatever their score."""
    found = []
    for kind, start, end in proposals(text):
        around = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
        score = SCORE[kind] + (BOOST if any(w in around for w in CONTEXT[kind]) else 0)
        if kind in BASE or score >= LEAST:
            found.append((kind, start, end, min(1.0, round(score, 2))))
    return found


def redacted(text: str, found: list[tuple[str, int, int, float]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, start, end, _ in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _possible(texts: pa.Array) -> np.ndarray:
    """Texts with a digit or an @; no others can hold a span."""
    data, bounds = text_bytes(texts)
    hits = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))])
    return hits[bounds[1:]] > hits[bounds[:-1]]


def find_spans(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """The rows of ``docs`` with their spans in column ``into``: kind, start, end (code points, end exclusive), score.

    Null and empty texts have no spans. All columns and rows stay, also repeated ones; ``into`` must be a
    new name. Spans of one kind do not overlap, those of different kinds may.
    """
    return _over(docs, text, into, change=False)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the spans of ``text`` replaced by their kinds; null stays null."""
    return _over(docs, text, None, change=True)


def _over(docs: DataFrame, text: str, into: str | None, change: bool) -> DataFrame:
    if into and into in docs.columns:
        raise ValueError(f"column {into} exists")
    # Names inside the task are positions, as given names may repeat in other cases.
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = names[docs.columns.index(text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            for part in slices(batch, at):
                texts = filled(part.column(at))
                hits = np.flatnonzero(_possible(texts))
                found = {int(k): spans(texts[int(k)].as_py()) for k in hits}
                columns = list(part.columns)
                if change:
                    whole = part.column(at).to_pylist()
                    columns[names.index(at)] = pa.array(
                        [redacted(t, found[k]) if found.get(k) else t for k, t in enumerate(whole)], part.column(at).type
                    )
                else:
                    rows = [[dict(zip(("kind", "start", "end", "score"), s)) for s in found.get(k, ())] for k in range(len(texts))]
                    columns.append(pa.array(rows, kind))
                yield pa.RecordBatch.from_arrays(columns, names=names if change else [*names, "spans"])

    fields = [(n, f) for n, f in zip(names, docs.schema)]
    schema = StructType()
    for n, f in fields:
        schema = schema.add(n, f.dataType, True)
    if not change:
        schema = schema.add("spans", _type(docs, SPANS), True)
    plain = docs.toDF(*names).mapInArrow(run, schema)
    return plain.toDF(*docs.columns, *([] if change else [into]))


def _type(df: DataFrame, ddl: str):
    return StructType.fromDDL(f"x {ddl}")[0].dataType


def listed(spans_column: str, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the given kinds, comma-joined, in the order of the kinds, then of the start."""
    order = {kind: k for k, kind in enumerate(KINDS)}
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    wanted = F.filter(spans_column, lambda s: s.kind.isin(*kinds))
    ordered = F.array_sort(F.transform(wanted, lambda s: F.struct(F.element_at(rank, s.kind).alias("r"), s.start, s.end, s.kind)))
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda span: span.kind == kind


def digest(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of their spans and all spans as text, per row."""
    found = find_spans(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")))
    counts = [F.size(F.filter("spans", _is(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(listed("spans", BASE), 256).alias("base_sha256"), listed("spans", KINDS).alias("spans")
    )
