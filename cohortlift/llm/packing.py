"""Best-fit packing of documents into sequences of a fixed number of tokens, as a tree of merges.

Method: hierarchical residual packing.  Items are dealt into nodes by hash and packed best-fit, largest
first, in each.  Bins that are nearly full, and bins that no other open bin could join, are
emitted; the rest go to the next, narrower level as items of their filled size, with their
members.  A level ends the tree when it has one node, or when merging no longer reduces the bins.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlift.llm.token_ids import encoded
from cohortlift.operators.pinning import stage

_PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ITEM_SCHEMA = _PIECE_SCHEMA + ", sequence_id long, offset long, fill long"

#: Rows a node packs at once.
NODE_ROWS = 65_536


def _pieces(path: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, ids, offsets in encoded(batch.column("text"), path, end_id):
                sizes = np.diff(offsets)
                count = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                begin = offsets[row] + start
                unsigned = ids.astype("<u4", copy=False)
                sums = [zlib.crc32(unsigned[b : b + n].data) for b, n in zip(begin, length)]
                columns = {
                    "doc_id": doc_ids.take(pa.array(first + row)), "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(sums, pa.int64()),
                }
                if with_ids:
                    edges = np.append(begin, offsets[-1]).astype(np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, with_ids: bool = False
) -> DataFrame:
    """Every document's ids with ``end_id`` appended, cut every ``capacity`` ids: one row per piece."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = _PIECE_SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.mapInArrow(_pieces(tokenizer_path, end_id, capacity, with_ids), schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: largest first, each into the fullest bin that still takes it."""
    bins, offsets = np.zeros((2, len(sizes)), dtype=np.int64)
    holding: dict[int, list[int]] = {}  # bins by what is left in them
    left: list[int] = []  # the keys of holding, ascending
    opened = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        at = bisect_left(left, size)
        if at < len(left):
            rest = left[at]
            bin_ = holding[rest].pop()
            if not holding[rest]:
                del holding[rest], left[at]
        else:
            bin_, rest = opened, capacity
            opened += 1
        bins[item], offsets[item] = bin_, capacity - rest
        rest -= size
        if rest:
            if rest not in holding:
                holding[rest] = []
                insort(left, rest)
            holding[rest].append(bin_)
    return bins, offsets


def _pack_node(level: int, capacity: int):
    def run(table: pa.Table) -> pa.Table:
        length = table.column("length").to_numpy()
        before = table.column("sequence_id").to_numpy()
        node = table.column("node")[0].as_py()
        # Rows come in any order; a fixed order makes reruns agree.
        order = np.lexsort([table.column("ids_crc32").to_numpy(), table.column("start").to_numpy(),
                            table.column("doc_id").fill_null(-1).to_numpy(), table.column("offset").to_numpy(),
                            before])
        table = table.take(pa.array(order))
        length, before = length[order], before[order]
        if level == 0:
            own = np.arange(len(length))
        else:
            own = np.unique(before, return_inverse=True)[1]
        fills = np.bincount(own, weights=length).astype(np.int64)
        bins, shift = best_fit(fills, capacity)
        total = np.bincount(bins, weights=fills).astype(np.int64)
        columns = {c: table.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
        columns["sequence_id"] = pa.array(((np.int64(level) << 32 | node) << 24) + bins[own])
        columns["offset"] = pa.array(table.column("offset").to_numpy() + shift[own])
        columns["fill"] = pa.array(total[bins[own]])
        return pa.table(columns)

    return run


def pack(docs: DataFrame, capacity: int = 4096, slack: int | None = None, node_rows: int = NODE_ROWS,
         **piece_options) -> DataFrame:
    """Place the pieces of documents in sequences of at most ``capacity`` ids; see ``pack_pieces``.

    Null texts are empty and give a piece that holds the end id alone; rows with a null or repeated doc_id are
    each packed; an empty table gives no row; columns other than doc_id and text are ignored, whatever their names.
    """
    return pack_pieces(stage(pieces(docs, capacity=capacity, **piece_options), "pieces"), capacity, slack, node_rows)


def pack_pieces(
    found: DataFrame, capacity: int = 4096, slack: int | None = None, node_rows: int = NODE_ROWS
) -> DataFrame:
    """Place pieces, as ``pieces`` gives them, in sequences of at most ``capacity`` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and the piece's offset in its
    sequence, without gaps from 0.  A bin counts as nearly full when at most ``slack`` ids are
    left (by default a 256th of the capacity).  A level whose bins are not 1 % fewer than the last one's is the
    last.
    """
    slack = capacity // 256 if slack is None else slack
    found = found.select(*(c.split()[0] for c in _PIECE_SCHEMA.split(", ")))
    items = found.withColumns({
        "sequence_id": F.xxhash64("doc_id", "piece", "start", "ids_crc32"), "offset": F.lit(0).cast("long"),
        "fill": F.col("length"),
    })
    emitted, level, n_bins = [], 0, math.inf
    n_rows = items.count()
    while True:
        nodes = max(1, -(-n_rows // node_rows))
        node = F.pmod(F.xxhash64("sequence_id", F.lit(level)), F.lit(nodes)).alias("node")
        packed = stage(
            items.select("*", node).groupBy("node").applyInArrow(_pack_node(level, capacity), _ITEM_SCHEMA),
            f"packed-{level}",
        )
        is_open = F.col("fill") < capacity - slack
        state = packed.where(is_open).agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("offset") == 0, 1)).alias("bins"),
            F.min("fill").alias("least"),
        ).first()
        # A bin that not even the least open bin could join is as full as it will get.
        joinable = is_open & (F.col("fill") + F.lit(state.least) <= capacity)
        done = nodes == 1 or not state.rows or state.bins > 0.99 * n_bins
        emitted.append(packed if done else packed.where(~F.coalesce(joinable, F.lit(False))))
        if done:
            break
        items, n_rows, n_bins, level = packed.where(joinable), state.rows, state.bins, level + 1
    out = emitted[0]
    for part in emitted[1:]:
        out = out.unionByName(part)
    return out.drop("fill")


def sequences(placed: DataFrame, pieces_with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves."""
    key = ["doc_id", "piece", "start", "ids_crc32"]
    one = Window.partitionBy(*key).orderBy("sequence_id", "offset")
    other = Window.partitionBy(*key).orderBy("length")
    numbered = placed.withColumn("_n", F.row_number().over(one))
    ids = pieces_with_ids.withColumn("_n", F.row_number().over(other)).drop("length")
    on = [numbered[c].eqNullSafe(ids[c]) for c in [*key, "_n"]]
    return numbered.join(ids, on).groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids")
    )
