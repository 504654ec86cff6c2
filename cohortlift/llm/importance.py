"""Target-distribution importance resampling: documents drawn by how target-like their word runs are.

Method: an Aho-Corasick dictionary of distinct words, each bounded by a delimiter on both sides and
carrying its CRC-32 and length.  One scan of the automaton over a text emits the payloads of its words; the
payloads of adjacent words compose to the CRC-32 of the run they form, without looking at the text again:
``crc(ab) = shift(crc(a), len(b)) ^ crc(b)``.  The CRC modulo the number of buckets is the run's bucket,
both where the buckets are counted and where documents are scored.

A worker's dictionary takes in the words that its texts bring until it holds ``MOST_WORDS``.  A word
that it does not hold is seen as a gap between emitted payloads and its CRC is computed from its bytes, so
the bound costs time only.  The dictionary is rebuilt from the texts wherever a lost task runs again.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlift.llm.words import Texts, runs, text_slices
from cohortlift.operators.pinning import stage
from cohortlift.operators.sharding import row_numbers

#: Words of a worker's dictionary at most; other words take the direct way.
MOST_WORDS = 1 << 16

#: Bytes that separate words: 0x00-0x2F, 0x3A-0x60 but A-Z, 0x7B-0x7F.
_DELIMITERS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(
    _DELIMITERS + bytes(range(ord("A"), ord("Z") + 1)), b" " * len(_DELIMITERS) + bytes(range(ord("a"), ord("z") + 1))
)


def _zero_byte_tables() -> np.ndarray:
    """For each power of two, four tables that carry a CRC-32 over that many zero bytes.

    The step over one zero byte is linear over bits, so a table per byte of the CRC is enough, and the step
    over twice as many bytes is the step taken twice.
    """
    one = np.array([zlib.crc32(b"\0", byte ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for byte in range(256)], dtype=np.uint32)
    values = np.arange(256, dtype=np.uint32)
    tables = [np.stack([one, *((values << np.uint32(8 * place)) >> np.uint32(8) for place in (1, 2, 3))])]
    for _ in range(31):
        tables.append(_stepped(tables[-1], tables[-1]))
    return np.stack(tables)


def _stepped(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    byte = np.uint32(0xFF)
    return (
        table[0][values & byte] ^ table[1][(values >> np.uint32(8)) & byte]
        ^ table[2][(values >> np.uint32(16)) & byte] ^ table[3][values >> np.uint32(24)]
    )


_ZEROS = _zero_byte_tables()


def composed(left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """CRC-32 of joined byte strings from the CRC-32 of both and the length of the right ones."""
    moved, rest, power = left.astype(np.uint32), right_length.astype(np.int64), 0
    while rest.any():
        moved = np.where(rest & 1, _stepped(_ZEROS[power], moved), moved)
        rest, power = rest >> 1, power + 1
    return moved ^ right


class WordDictionary:
    """Delimiter-bounded words in an automaton; a word's payload is ``length << 32 | crc``."""

    def __init__(self, most: int = MOST_WORDS) -> None:
        self.most = most
        self.automaton = ahocorasick.Automaton()
        self.waiting: dict[bytes, int] = {}

    def scan(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRCs and lengths of all words of the rows, and each row's first word (one more than rows)."""
        # A delimiter before every row and at the end keeps rows and words apart.
        data = np.insert(texts.data, texts.offsets, 0x20).tobytes().translate(_FOLD)
        offsets = texts.offsets + np.arange(len(texts.offsets))
        raw = np.frombuffer(data, dtype=np.uint8)
        starts, ends, first = runs(raw != 0x20, offsets)
        payloads = np.full(len(starts), -1, dtype=np.int64)
        if len(self.automaton) and len(starts):
            found = self.automaton.iter(data.decode("latin-1"))
            emitted = np.fromiter(itertools.chain.from_iterable(found), dtype=np.int64).reshape(-1, 2)
            payloads[np.searchsorted(ends, emitted[:, 0])] = emitted[:, 1]
        for word in np.flatnonzero(payloads < 0).tolist():
            payloads[word] = self._outside(data[starts[word] : ends[word]])
        self._take_in()
        return (payloads & 0xFFFFFFFF).astype(np.uint32), payloads >> 32, first

    def _outside(self, word: bytes) -> int:
        payload = self.waiting.get(word)
        if payload is None:
            payload = len(word) << 32 | zlib.crc32(word)
            if len(self.automaton) + len(self.waiting) < self.most:
                self.waiting[word] = payload
        return payload

    def _take_in(self) -> None:
        if 4 * len(self.waiting) > len(self.automaton):
            for word, payload in self.waiting.items():
                self.automaton.add_word(f" {word.decode('latin-1')} ", payload)
            self.automaton.make_automaton()
            self.waiting = {}


def run_buckets(
    crcs: np.ndarray, lengths: np.ndarray, first: np.ndarray, width: int, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1 to ``width`` words, joined by one space: buckets and each row's first run."""
    n_words = np.diff(first)
    spaced = composed(np.full(len(crcs), zlib.crc32(b" "), dtype=np.uint32), crcs, lengths)
    whole = crcs
    for size in range(1, width + 1):
        if size > 1:
            whole = composed(whole[:-1], spaced[size - 1 :], lengths[size - 1 :] + 1)
        count = np.maximum(n_words - size + 1, 0)
        into = np.concatenate(([0], np.cumsum(count)))
        at = np.repeat(first[:-1] - into[:-1], count) + np.arange(into[-1])
        yield (whole[at] % np.uint32(buckets)).astype(np.int64), into


def _counting(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = WordDictionary(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                for found, _ in run_buckets(*words.scan(texts), width, buckets):
                    counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, width: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts: every task sends a row for each bucket it met."""
    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _counting(width, buckets), "bucket long, n long"
    )
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most ``buckets`` rows
    counts = np.zeros(buckets, dtype=np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source frequency, both with one added to each bucket."""
    buckets = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(
        1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))
    ).astype(np.int64)


def _weighing(width: int, gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordDictionary()
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                crcs, lengths, first = words.scan(texts)
                sums, number = np.zeros((2, texts.rows), dtype=np.int64)
                for found, into in run_buckets(crcs, lengths, first, width, len(gains)):
                    upto = np.concatenate(([0], np.cumsum(gains[found])))
                    sums += upto[into[1:]] - upto[into[:-1]]
                    number += np.diff(into)
                weight = sums // np.maximum(number, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(texts.first, texts.rows), pa.array(np.diff(first)),
                     pa.array(number), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def resample(
    docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000, percent: int = 10,
    least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    ``target`` has the texts whose distribution is wanted.  A document's weight is the floored mean gain of
    its features' buckets (0 without features) and its score adds Gumbel noise hashed from ``seed`` and
    doc_id.  Of the N rows with at least ``least_words`` words, the floor(percent N / 100) highest scores are
    drawn and ranked from 1; other rows have a null rank.

    Null texts count as empty.  Rows that share a doc_id are separate documents with the same noise; equal
    scores go to the smaller doc_id, nulls first, then to more features and the greater weight; rows equal in
    all of these share out neighbouring ranks.  A null doc_id hashes as an empty one.  An empty target gives
    every word the gain it has against no evidence; an empty table an empty result.  Extra columns are ignored.
    """
    gains = bucket_gains(bucket_counts(docs, width, buckets), bucket_counts(target, width, buckets))
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _weighing(width, gains), f"doc_id {kind}, n_words long, n_features long, weight long"
    )
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn_at = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn_at + 0.5) / 4294967296.0)))
    scored = stage(weighed.withColumn("score", F.col("weight") + noise), "resampled")
    return _ranked(scored, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def _ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Ranks by score.  Scores are whole thousandths of logarithms, so a table of their counts stays small
    whatever the input and shows from which score on rows can be drawn; only those are ordered."""
    able = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    levels = scored.where(able).groupBy("score").count().toArrow()
    order = np.argsort(-levels.column("score").to_numpy())
    score, count = levels.column("score").to_numpy()[order], levels.column("count").to_numpy()[order]
    wanted = percent * int(count.sum()) // 100
    before = np.cumsum(count) - count
    lowest = int(score[before < wanted].min()) if wanted else None
    near = able & (F.col("score") >= lowest) if wanted else F.lit(False)
    places = row_numbers(
        scored.where(near), [F.desc("score"), F.asc("doc_id"), F.desc("n_features"), F.desc("weight")], "place"
    )
    drawn = places.withColumn("rank", F.when(F.col("place") <= wanted, F.col("place"))).drop("place")
    return scored.where(~near).withColumn("rank", F.lit(None).cast("long")).unionByName(drawn)


def drawn(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id was drawn, with all their columns; for tables with one row a doc_id."""
    return docs.join(ranked.where("rank is not null").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
