"""Benchmark decontamination by a positional inverted index of the training words.

``build`` stores the index: documents are dealt into blocks, and every (block, word) has a posting list of
the word's places, counted through the block's documents.  A common word thus has one list a block, never one
for the corpus.  The empty word's list holds the places where documents begin and, last, the block's end.

``matches`` looks a set of test items up, a bounded block of items at a time.  In each block of the index, a
window of test words starts from the posting list of its rarest word there, moved back by the word's place
in the window, and is intersected with the moved lists of its other words from rare to common.  With ``slop``
0 what is left are exact phrases; otherwise a window may be laid anywhere and each of its words found up to
``slop`` words from its place there (proximity matches).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlift.llm.staging import Stages
from cohortlift.llm.words import runs, text_slices

#: Bytes of text in a block of the index (a longer text is a block of its own), words in a block of items,
#: and candidate places that a step of a look-up holds.
BLOCK_BYTES, ITEM_WORDS, CANDIDATES = 1 << 22, 1 << 18, 1 << 20
#: Words that an item is cut to before items are dealt into blocks; the windows at a cut are kept.
ITEM_PART = 1 << 14

#: Separators of words: 0x00-0x2F, 0x3A-0x60 but A-Z, 0x7B-0x7F.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_INDEX = "part string, block long, place int, doc_id {kind}, n_words long, term string, places array<int>"
_FOUND = "block long, place int, begins array<int>, ends array<int>, items array<string>"
_FOUND_SCHEMA = pa.schema([
    ("block", pa.int64()), ("place", pa.int32()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
    ("items", pa.list_(pa.string())),
])
_HITS = "spans array<struct<begin:int,end:int>>, items array<string>"


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as strings."""
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    at = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[at]))
    ).cast(pa.string())


def _lists(offsets: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _posting(kind: pa.DataType, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's blocks are numbered within its partition, so that a repeated task gives the same numbers.
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in text_slices(batch.column("text"), BLOCK_BYTES):
                starts, ends, first = texts.spans(BREAKS)
                words = texts.word_hashes(starts, ends)
                order = np.argsort(words, kind="stable")
                new = np.ones(len(words), dtype=bool)
                new[1:] = words[order[1:]] != words[order[:-1]]
                heads = np.flatnonzero(new)
                terms = _strings(_LOWER[texts.data], starts[order[heads]], ends[order[heads]])
                yield _rows(schema, len(terms), part="term", block=block, term=terms,
                            places=_lists(np.append(heads, len(order)), order))
                yield _rows(schema, 1, part="term", block=block, term=pa.array([""]),
                            places=_lists(np.array([0, len(first)]), first))
                yield _rows(schema, texts.rows, part="document", block=block,
                            place=pa.array(np.arange(texts.rows), pa.int32()), n_words=pa.array(np.diff(first)),
                            doc_id=batch.column("doc_id").slice(texts.first, texts.rows))
                block += 1

    return run


def _rows(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    full = []
    for field in schema:
        value = columns.get(field.name)
        full.append(value if isinstance(value, pa.Array) else pa.array([value] * size, field.type))
    return pa.RecordBatch.from_arrays(full, schema=schema)


def build(docs: DataFrame, path: str) -> None:
    """Write the index of all words of ``docs``: folders ``part=term`` and ``part=document`` below ``path``.

    Words are runs of digits, letters and bytes from 0x80 on, with A-Z lower-cased.  Null texts have no
    words; rows that share a doc_id stay separate documents; extra columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    schema = pa.schema([
        ("part", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("doc_id", to_arrow_type(kind)),
        ("n_words", pa.int64()), ("term", pa.string()), ("places", pa.list_(pa.int32())),
    ])
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = source.mapInArrow(_posting(kind, schema), _INDEX.format(kind=kind.simpleString()))
    rows.write.partitionBy("part").parquet(path)


class Index:
    """An index that ``build`` wrote."""

    def __init__(self, spark: SparkSession, path: str, kind: str = "long") -> None:
        read = spark.read.schema(_INDEX.format(kind=kind)).parquet(path)
        self.terms = read.where("part = 'term'").select("block", "term", "places")
        self.documents = read.where("part = 'document'").select("block", "place", "doc_id", "n_words")


def _item_words(width: int):
    """Items as lists of at most ``ITEM_PART`` words that together hold each window once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                starts, ends, first = texts.spans(BREAKS)
                words = _strings(_LOWER[texts.data], starts, ends)
                items, parts = [], []
                for row in range(texts.rows):
                    item, upto = batch.column("item")[texts.first + row].as_py(), int(first[row + 1])
                    windows = range(int(first[row]), max(upto - width + 1, int(first[row]) + 1), ITEM_PART - width + 1)
                    for begin in windows if upto > first[row] else ():
                        items.append(item)
                        parts.append(words[begin : min(begin + ITEM_PART, upto)].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.string()), pa.array(parts, pa.list_(pa.string()))], names=["item", "words"]
                )

    return run


class Windows:
    """The distinct windows of a block of items: ids of their words, lengths, and whose they are."""

    def __init__(self, items: list[str], words: list[list[str]], width: int) -> None:
        self.items = pa.array(items, pa.string())
        self.vocabulary = sorted({word for text in words for word in text})
        number = {word: i for i, word in enumerate(self.vocabulary)}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in enumerate(words):
            ids = [number[word] for word in text]
            for begin in range(max(len(ids) - width, 0) + 1 if ids else 0):
                owners.setdefault(tuple(ids[begin : begin + width]), set()).add(item)
        self.lengths = np.array([len(w) for w in owners], dtype=np.int64)
        self.ids = np.full((len(owners), width), -1, dtype=np.int64)
        for row, window in enumerate(owners):
            self.ids[row, : len(window)] = window
        self.owner_at = np.concatenate(([0], np.cumsum([len(o) for o in owners.values()]))).astype(np.int64)
        self.owners = np.array([item for o in owners.values() for item in sorted(o)], dtype=np.int64)

    def occurrences(
        self, counts: np.ndarray, keys: np.ndarray, first: np.ndarray, slop: int
    ) -> Iterator[tuple[np.ndarray, ...]]:
        """(window, document, first word, last word) of all places where a window's words lie, of a block.

        ``counts`` are the lengths of the posting lists, ``keys`` the lists themselves, word after word, as
        ``word << 32 | place``, and ``first`` the places where documents begin.
        """
        begin = np.cumsum(counts) - counts
        often = np.where(self.ids >= 0, counts[self.ids], np.iinfo(np.int64).max)
        rank = np.argsort(often, axis=1, kind="stable")
        alive = np.flatnonzero(often[np.arange(len(rank)), rank[:, 0]] > 0)
        upto = np.concatenate(([0], np.cumsum(often[alive, rank[alive, 0]])))
        for low in range(0, int(upto[-1]), CANDIDATES):  # bounded steps, also within one long list
            spots = np.arange(low, min(low + CANDIDATES, int(upto[-1])))
            nth = np.searchsorted(upto, spots, side="right") - 1
            offset = rank[alive[nth], 0]
            place = keys[begin[self.ids[alive[nth], offset]] + spots - upto[nth]] & 0xFFFFFFFF
            # All ways to lay the window so that its rarest word is near enough to its place.
            shifts = np.arange(-slop, slop + 1)
            window, start = np.repeat(alive[nth], len(shifts)), (place[:, None] - offset[:, None] + shifts).reshape(-1)
            document = np.repeat(np.searchsorted(first, place, side="right") - 1, len(shifts))
            least = most = np.repeat(place, len(shifts))
            for step in range(self.ids.shape[1]):
                going = self.lengths[window] > step
                offset = rank[window, step]
                word, due = self.ids[window, offset], start + offset
                lowest = np.maximum(due - slop, first[document])
                at = np.minimum(np.searchsorted(keys, (word << 32) + lowest), len(keys) - 1)
                met = keys[at] & 0xFFFFFFFF
                near = (keys[at] >> 32 == word) & (met >= lowest) & (met <= due + slop) & (met < first[document + 1])
                met, kept = np.where(going, met, least), near | ~going
                least, most = np.minimum(least, met)[kept], np.maximum(most, met)[kept]
                window, document, start = window[kept], document[kept], start[kept]
                if not len(window):
                    break
            if len(window):
                yield window, document, least, most


def _looking_up(shared, slop: int):
    def run(table: pa.Table) -> pa.Table:
        windows: Windows = shared.value
        block = table.column("block")[0].as_py()
        word = pc.index_in(table.column("term"), pa.array(["", *windows.vocabulary]))
        table = table.append_column("id", word).sort_by("id").combine_chunks()
        lists = table.column("places").chunk(0)
        ids = table.column("id").to_numpy().astype(np.int64)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        first, places = flat[: sizes[0]], flat[sizes[0] :]
        counts = np.zeros(len(windows.vocabulary) + 1, dtype=np.int64)  # the last one stands for no word
        counts[ids[1:] - 1] = sizes[1:]
        keys = (np.repeat(ids[1:] - 1, sizes[1:]) << 32) | places
        marks = np.zeros(first[-1] + 1, dtype=np.int32)
        owned = []
        if len(keys):
            for window, document, least, most in windows.occurrences(counts, keys, first, slop):
                np.add.at(marks, least, 1)
                np.add.at(marks, most + 1, -1)
                pairs = np.unique(document * len(windows.lengths) + window)
                document, window = pairs // len(windows.lengths), pairs % len(windows.lengths)
                number = np.diff(windows.owner_at)[window]
                into = np.cumsum(number) - number
                at = np.repeat(windows.owner_at[window] - into, number) + np.arange(number.sum())
                owned.append(np.unique(np.repeat(document, number) * len(windows.items) + windows.owners[at]))
        if not owned:
            return pa.Table.from_batches([], _FOUND_SCHEMA)
        owned = np.unique(np.concatenate(owned))
        document, item = owned // len(windows.items), owned % len(windows.items)
        hit, at = np.unique(document, return_index=True)
        begins, ends, span_at = runs(np.cumsum(marks[:-1]) > 0, first)
        span_at = np.append(span_at[hit], len(begins))  # documents without a hit have no spans between these
        shift = np.repeat(first[hit], np.diff(span_at))
        owners = windows.items.take(pa.array(item))
        return pa.Table.from_arrays(
            [pa.array([block] * len(hit), pa.int64()), pa.array(hit, pa.int32()),
             _lists(span_at, begins - shift), _lists(span_at, ends - shift),
             pa.ListArray.from_arrays(pa.array(np.append(at, len(item)), pa.int32()), owners)], schema=_FOUND_SCHEMA,
        )

    return run


def _merging(table: pa.Table) -> pa.Table:
    """One row for each document of a block: what the blocks of items found, ranges that meet made one."""
    rows: dict[int, list[dict]] = {}
    for row in table.to_pylist():
        rows.setdefault(row["place"], []).append(row)
    spans, items = [], []
    for found in rows.values():
        begins, ends = (np.concatenate([r[name] for r in found]) for name in ("begins", "ends"))
        order = np.argsort(begins, kind="stable")
        begins, reach = begins[order], np.maximum.accumulate(ends[order])
        new = np.append(True, begins[1:] > reach[:-1])
        last = np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)
        spans.append([{"begin": b, "end": e} for b, e in zip(begins[new].tolist(), reach[last].tolist())])
        items.append(sorted({item for r in found for item in r["items"]}))
    return pa.table({
        "block": pa.array([table.column("block")[0].as_py()] * len(rows), pa.int64()), "place": pa.array(rows, pa.int32()),
        "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
        "items": pa.array(items, pa.list_(pa.string())),
    })


def _item_blocks(items: DataFrame, tables: Stages, width: int) -> Iterator[Windows]:
    """The items' windows in blocks of about ``ITEM_WORDS`` words, one at a time through the driver."""
    split = tables.write(
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                     F.col("text").cast("string").alias("text")).mapInArrow(_item_words(width), "item string, words array<string>"), "items",
    )
    total = split.agg(F.sum(F.size("words"))).first()[0] or 0
    number = -(-total // ITEM_WORDS)
    for block in range(number):
        part = split.where(F.pmod(F.xxhash64("item", "words"), F.lit(number)) == block).toArrow()
        yield Windows(part.column("item").to_pylist(), part.column("words").to_pylist(), width)


def matches(index: Index, items: DataFrame, width: int = 10, slop: int = 0) -> DataFrame:
    """(block, place, spans, items) of every document in which a window of an item occurs.

    A window is ``width`` consecutive words of an item, or the whole item if it has fewer; an item without
    words has none.  ``spans`` are the [begin, end) word ranges that occurrences cover, merged and ascending;
    ``items`` the item_ids, as strings, whose windows occur.  A null item_id stands as an empty string, rows that
    share an item_id are one item of several texts.
    """
    spark = items.sparkSession
    tables = Stages(spark, "lookup")
    found = spark.createDataFrame([], _FOUND)
    for windows in _item_blocks(items, tables, width):
        words = spark.createDataFrame(pa.table({"term": ["", *windows.vocabulary]}))
        shared = spark.sparkContext.broadcast(windows)
        lists = index.terms.join(F.broadcast(words), "term", "left_semi")  # ITEM_WORDS words at most
        found = found.unionByName(
            tables.write(lists.groupBy("block").applyInArrow(_looking_up(shared, slop), _FOUND), "found")
        )
    return found.groupBy("block").applyInArrow(_merging, f"block long, place int, {_HITS}")


def contamination(docs: DataFrame, items: DataFrame, path: str, width: int = 10, slop: int = 0) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs``, by way of an index written at ``path``.

    ``spans`` and ``items`` are empty where no window of ``items`` occurs.  Null and empty texts have no
    words; an empty table of items leaves every document clean; an empty table of documents gives an empty
    result.
    """
    build(docs, path)
    index = Index(docs.sparkSession, path, docs.schema["doc_id"].dataType.simpleString())
    hits = matches(index, items, width, slop)
    joined = index.documents.join(hits, ["block", "place"], "left")
    none = {name: F.array().cast(hits.schema[name].dataType) for name in ("spans", "items")}
    return joined.select("doc_id", "n_words", *(F.coalesce(n, none[n]).alias(n) for n in ("spans", "items")))
