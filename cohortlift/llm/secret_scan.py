"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Method: candidate strings are maximal runs of token characters.  A window of set width slides over
each while the counts of its characters, and with them its Shannon entropy, are updated by one
character in and one out.  A window belongs to the narrowest of three character classes with a
maximal run that holds it and that no allow-list entry matches.  Windows at or above their class's threshold are
merged into spans by class, unless an entry matches the whole candidate; windows that are half alphabet or
counting up are left out one by one, so that they hide nothing beside them.  Positions are code points.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlift.llm.words import runs, text_slices

#: The kinds in the order in which spans of equal start are listed.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")
BASE_KINDS = KINDS[:3]

# Fixed patterns and least lengths.
_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

WINDOW = 20
#: Entropy in bits from which a window is flagged, by class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.7, "base64": 3.9}

#: Characters from which a run that counts up by one each time, as alphabets and digits do, is no secret.
RISING = 6
#: Candidates that match one of these as a whole are no secrets: words without digits joined by
#: separators, numbers and dates, rules of repeated marks.
ALLOWED = (
    r"[A-Za-z]+(?:[-_/+=]+[A-Za-z]+)*[-_/+=]*",
    r"[-_/+=]*[0-9]+(?:[-_/+=]+[0-9]+)*[-_/+=]*",
    r"(.{1,4})\1{4,}.{0,3}",
    r"(?:[A-Za-z]+[0-9]{0,4}[-_/])*[A-Za-z]+[0-9]{0,4}",
)

def _members(characters: str) -> np.ndarray:
    held = np.zeros(256, dtype=bool)
    held[[ord(c) for c in characters]] = True
    return held


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX_RUN = _members(_DIGITS + "abcdef")
_CANDIDATE = _members(_DIGITS + _LOWER + _UPPER + "+/_=-")
#: Maximal runs of the classes inside a candidate, wide classes first; hex is of one case.
_RUNS_OF = tuple((name, re.compile(b"[%s]{%d,}" % (inside, WINDOW))) for name, inside in (
    ("alnum", b"A-Za-z0-9"), ("hex", b"0-9a-f"), ("hex", b"0-9A-F"),
))


def window_entropies(candidate: bytes, width: int = WINDOW) -> list[float]:
    """Shannon entropy in bits of every window of ``width`` bytes, by incremental counts."""
    weight = [0.0, 0.0] + [n * math.log2(n) for n in range(2, width + 1)]
    counts = [0] * 256
    total, found = 0.0, []
    for at, byte in enumerate(candidate):
        counts[byte] += 1
        total += weight[counts[byte]] - weight[counts[byte] - 1]
        if at >= width - 1:
            found.append(math.log2(width) - total / width)
            out = candidate[at - width + 1]
            counts[out] -= 1
            total += weight[counts[out]] - weight[counts[out] + 1]
    return found


def _half_rising(candidate: bytes) -> list[int]:
    """Windows of which at least half lies in rising runs."""
    inside, begin = [0] * len(candidate), 0
    for at in range(1, len(candidate) + 1):
        if at == len(candidate) or candidate[at] != candidate[at - 1] + 1:
            if at - begin >= RISING:
                inside[begin:at] = [1] * (at - begin)
            begin = at
    if not any(inside):
        return []
    held, found = sum(inside[:WINDOW]), []
    for at in range(len(candidate) - WINDOW + 1):
        if 2 * held >= WINDOW:
            found.append(at)
        held += (inside[at + WINDOW] if at + WINDOW < len(candidate) else 0) - inside[at]
    return found


def _entropy_spans(
    candidate: bytes, allowed: Sequence[re.Pattern], thresholds: dict[str, float]
) -> Iterator[tuple[str, int, int]]:
    if any(pattern.fullmatch(candidate) for pattern in allowed):
        return
    kinds = ["base64"] * (len(candidate) - WINDOW + 1)
    for kind, pattern in _RUNS_OF:
        for run in pattern.finditer(candidate):
            if not any(entry.fullmatch(run[0]) for entry in allowed):
                kinds[run.start() : run.end() - WINDOW + 1] = [kind] * (len(run[0]) - WINDOW + 1)
    for at in _half_rising(candidate):
        kinds[at] = ""
    spans: dict[str, tuple[int, int]] = {}
    for at, (kind, bits) in enumerate(zip(kinds, window_entropies(candidate))):
        if kind and bits >= thresholds[kind] - 1e-9:
            begin, end = spans.get(kind, (at, at))
            if at > end:
                yield f"entropy_{kind}", begin, end
                begin = at
            spans[kind] = begin, at + WINDOW
    for kind, (begin, end) in spans.items():
        yield f"entropy_{kind}", begin, end


def find_secrets(
    column: pa.Array, allowed: Sequence[str] = ALLOWED, thresholds: dict[str, float] = THRESHOLDS
) -> Iterator[list[tuple[int, int, int]]]:
    """For each text (start, kind's place in ``KINDS``, end), ascending, in code points."""
    patterns = [re.compile(p.encode()) for p in allowed]
    for texts in text_slices(column):
        data = texts.data.tobytes()
        found: list[tuple[int, int, int]] = []  # in bytes of the slice
        offsets = texts.offsets.tolist()
        for begin, end in zip(offsets[:-1], offsets[1:]):
            if data.find(b"=", begin, end) >= 0 or data.find(b":", begin, end) >= 0:
                found.extend((m.start(), 0, m.end()) for m in _ASSIGN.finditer(data, begin, end)
                             if m.end(2) - m.start(2) >= ASSIGN_LEAST)
            if data.find(b"AKIA", begin, end) >= 0:
                found.extend((m.start(), 1, m.end()) for m in _ACCESS.finditer(data, begin, end)
                             if m.end() - m.start() >= ACCESS_LEAST)
        starts, ends, _ = runs(_HEX_RUN[texts.data], texts.offsets)
        long = ends - starts >= HEX_LEAST
        found.extend((s, 2, e) for s, e in zip(starts[long].tolist(), ends[long].tolist()))
        starts, ends, _ = runs(_CANDIDATE[texts.data], texts.offsets)
        long = ends - starts >= WINDOW
        for s, e in zip(starts[long].tolist(), ends[long].tolist()):
            found.extend((s + a, KINDS.index(kind), s + b)
                         for kind, a, b in _entropy_spans(data[s:e], patterns, thresholds))
        rows: list[list[tuple[int, int, int]]] = [[] for _ in range(texts.rows)]
        if found:
            found.sort()
            points = np.zeros(len(texts.data) + 1, dtype=np.int64)
            np.cumsum((texts.data & 0xC0) != 0x80, out=points[1:])
            owner = np.searchsorted(texts.offsets, [f[0] for f in found], side="right") - 1
            for row, (s, kind, e) in zip(owner.tolist(), found):
                base = points[offsets[row]]
                rows[row].append((int(points[s] - base), kind, int(points[e] - base)))
        yield from rows


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row, spans an array of (start, kind, end) ordered by start, then kind.

    Null texts are empty and have no span; any doc_id, null or repeated, keeps its row; extra columns are
    ignored; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in row]
                     for row in find_secrets(batch.column("text"))]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, "doc_id long, spans array<struct<start:bigint,kind:string,`end`:bigint>>")


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))


def redact(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``, overlapping spans by one.

    Texts without a secret, and nulls, stay as they are; ``n_chars`` follows the text where it changes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            changed = {}
            for row, spans in enumerate(find_secrets(column)):
                if spans:
                    text, parts, at, upto = column[row].as_py(), [], 0, -1
                    for start, _, end in spans:
                        if start >= upto:
                            parts += [text[at:start], mask]
                        at = upto = max(upto, end)
                    changed[row] = "".join([*parts, text[at:]])
            if changed:
                names = batch.schema.names
                columns = list(batch.columns)
                texts = column.to_pylist()
                for row, text in changed.items():
                    texts[row] = text
                columns[names.index("text")] = pa.array(texts, column.type)
                if "n_chars" in names:
                    counts = batch.column("n_chars").to_pylist()
                    for row, text in changed.items():
                        counts[row] = len(text)
                    columns[names.index("n_chars")] = pa.array(counts, batch.column("n_chars").type)
                batch = pa.RecordBatch.from_arrays(columns, names=names)
            yield batch

    return docs.mapInArrow(run, docs.schema)
