"""Vector code compression: product codes whose nearest entries are found through integer Walsh-Hadamard transforms.

Components become whole numbers, vectors are cut into parts, and every part position has a codebook that a
few rounds of assigning and averaging refine.  A part and an entry, padded with zeros to a power of two L, are
transformed by the Walsh-Hadamard matrix in sequency order (rows by their number of sign changes).  Squared
differences of the transformed values sum to exactly L times the squared distance, and most of it tends to
lie in the first values, so that entries whose partial sum already exceeds the full sum of a good entry are
left out early.  All of it is whole-number arithmetic: no result depends on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlift.llm.staging import Stages

#: Components are clamped to this on either side, far beyond what a long can hold squared.
CLAMP = 1 << 52
#: Up to this size sums of squares stay within 64 bits for parts of up to 64 components; beyond it, and for longer
#: parts, the same steps run on Python's whole numbers.
_SMALL = 1 << 20
_LONG_MOST = (1 << 63) - 1
_ROWS = 4096


def sequency_matrix(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows by their number of sign changes."""
    matrix = np.ones((1, 1), dtype=np.int64)
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """Rows padded with zeros to a power of two and transformed."""
    size = 1 << max(parts.shape[1] - 1, 0).bit_length()
    return parts @ sequency_matrix(size)[:, : parts.shape[1]].T.astype(parts.dtype)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the index of its nearest entry (the lower one of a tie) and their squared distance."""
    left, right = transformed(parts), transformed(entries)
    rows, size = left.shape
    head = min(2, size)
    partial = sum((left[:, [j]] - right[None, :, j]) ** 2 for j in range(head))
    # The full sum of the entry that leads so far bounds what the nearest one can have.
    lead = partial.argmin(axis=1)
    bound = ((left - right[lead]) ** 2).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    total = partial[row, entry]
    for j in range(head, size):
        total = total + (left[row, j] - right[entry, j]) ** 2
        kept = total <= bound[row]
        row, entry, total = row[kept], entry[kept], total[kept]
    # Rows come in order with their entries ascending: the first least sum of each is wanted.
    first = np.searchsorted(row, np.arange(rows))
    least = np.minimum.reduceat(total, first) if rows else total
    hit = np.flatnonzero(total == least[row])
    hit = hit[np.searchsorted(row[hit], np.arange(rows))]
    return entry[hit], least // size


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Whole-number vectors as rows; of Python numbers where 64 bits might not do."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    small = not len(values) or max(int(values.max()), -int(values.min())) <= _SMALL
    return values if small else values.astype(object)


def _assigned(vectors: np.ndarray, codebooks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: the parts, their entries' indices and squared distances."""
    width = vectors.shape[1] // len(codebooks)
    for place, entries in enumerate(codebooks):
        parts = vectors[:, place * width : (place + 1) * width]
        plain = parts.dtype != object and width <= 64 and int(np.abs(entries).max()) <= _SMALL
        kind = np.int64 if plain else object
        yield parts, *nearest(parts.astype(kind), entries.astype(kind))


def _summing(codebooks: list[np.ndarray]):
    """Each task's sums and counts per (part, entry); sums as two limbs, so that adding them up cannot overflow."""
    dimension = len(codebooks) * codebooks[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(codebooks), *codebooks[0].shape)
        sums, counts = np.zeros(shape, dtype=object), np.zeros(shape[:2], dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                vectors = _matrix(batch.column("vector").slice(low, _ROWS), dimension)
                for place, (parts, found, _) in enumerate(_assigned(vectors, codebooks)):
                    for entry in np.unique(found):
                        members = parts[found == entry]
                        sums[place, entry] += members.sum(axis=0)
                        counts[place, entry] += len(members)
        part, entry = np.nonzero(counts)
        flat = [int(v) for place, at in zip(part, entry) for v in sums[place, at]]
        offsets = pa.array(np.arange(len(part) + 1) * shape[2], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts[part, entry]),
             pa.ListArray.from_arrays(offsets, pa.array([v >> 32 for v in flat], pa.int64())),
             pa.ListArray.from_arrays(offsets, pa.array([v & 0xFFFFFFFF for v in flat], pa.int64()))],
            names=["part", "entry", "n", "high", "low"],
        )

    return run


def refined(vectors: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks with each entry replaced by the floored mean of its parts; unused entries stay."""
    tasks = vectors.mapInArrow(_summing(codebooks), "part long, entry long, n long, high array<long>, low array<long>")
    spots = tasks.select("part", "entry", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "sum"))
    totals = spots.groupBy("part", "entry", "at").agg(
        F.sum("n").alias("n"), F.sum("sum.high").alias("high"), F.sum("sum.low").alias("low")
    )
    out = [entries.copy() for entries in codebooks]
    # A row for each component of each entry, fetched by one job: toLocalIterator() would run one a partition.
    for row in totals.collect():
        out[row.part][row.entry, row.at] = ((row.high << 32) + row.low) // row.n
    return out


def _coding(codebooks: list[np.ndarray]):
    dimension = len(codebooks) * codebooks[0].shape[1]
    digits = max(2, len(f"{len(codebooks[0]) - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                found = list(_assigned(_matrix(part.column("vector"), dimension), codebooks))
                codes = zip(*(indices.tolist() for _, indices, _ in found))
                error = sum(distance for _, _, distance in found)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"),
                     pa.array(["".join(f"{i:0{digits}x}" for i in code) for code in codes], pa.string()),
                     pa.array([min(int(e), _LONG_MOST) for e in error], pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


class Codes:
    """Whole-number vectors, as ``prepare`` stages them, and their codebooks."""

    def __init__(self, vectors: DataFrame, codebooks: list[np.ndarray]) -> None:
        self.vectors, self.codebooks = vectors, codebooks

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position."""
        flat = [str(int(v)) for entries in self.codebooks for row in entries for v in row]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def encode(self) -> DataFrame:
        """(vec_id, label, code, error) of every vector: the code is two hex digits or more a part."""
        kinds = {f.name: f.dataType.simpleString() for f in self.vectors.schema}
        schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
        if not self.codebooks:
            return self.vectors.sparkSession.createDataFrame([], schema)
        return self.vectors.mapInArrow(_coding(self.codebooks), schema)


def prepare(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """(vec_id, label, vector) with components floor(scale x), without rows that take no part.

    Those are null vectors, vectors with a null or non-finite component, and, since parts must be equal, vectors
    of another length than that of the least vec_id's vector.  Vectors are padded with zeros to a multiple of
    ``parts``.
    """
    held = rows.where("embedding is not null and size(embedding) > 0").where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    first = held.select("vec_id", F.size("embedding").alias("n")).orderBy(F.asc_nulls_last("vec_id"), "n").first()
    least = first.n if first else 0
    whole = F.transform("embedding", lambda x: F.greatest(F.least(
        F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-2.0 * CLAMP)), F.lit(2.0 * CLAMP))), F.lit(CLAMP)
    ), F.lit(-CLAMP)))
    padding = F.array_repeat(F.lit(0).cast("long"), -least % parts)
    return held.where(F.size("embedding") == least).select("vec_id", "label", F.concat(whole, padding).alias("vector"))


def train(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codes:
    """Codebooks of ``rows`` (vec_id, embedding, label).

    They start as the parts of the ``entries`` smallest vec_ids (of rows that share one, the smaller vectors
    first; all rows, if fewer), nulls last.  Rows that share a vec_id are separate vectors.  Components beyond
    2^52 after scaling are clamped.  An empty table has no codebooks and no codes.  Extra columns are ignored.
    """
    vectors = Stages(rows.sparkSession, "codes").write(prepare(rows, parts, scale), "vectors")
    seeds = np.array([r.vector for r in vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()], dtype=np.int64)
    codebooks = np.split(seeds, parts, axis=1) if len(seeds) else []
    for _ in range(rounds if codebooks else 0):
        codebooks = refined(vectors, codebooks)
    return Codes(vectors, codebooks)


def label_errors(encoded: DataFrame) -> DataFrame:
    """``encoded`` with ``label_error``, the error summed over equal labels, nulls together."""
    sums = encoded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error")).select(
        F.col("label").alias("of"), F.least("label_error", F.lit(_LONG_MOST)).cast("long").alias("label_error")
    )
    return encoded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
