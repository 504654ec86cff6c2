"""N-gram Jaccard join: documents whose word shingle sets are alike, as components of links.

Method: multiple-global-order prefix filtering.  Two sets of similarity t or more share a token
among the first ``n - ceil(t n) + 1`` of each under *every* global order of the tokens.  The
orders here put tokens in classes by document frequency, rare classes first, and differ by the
hash that orders a class.  Frequencies come from a sketch of fixed size over all documents; an order
by a sketch is still one order for all, so its errors cost time only.  Candidates are found by
the first order, kept where the other orders' prefixes meet too, and then verified on whole texts.

Groups of documents under one prefix token are never expanded into all pairs.  A few pivots of each
group, those that share the most with others, are compared with its members; verified links are merged
into components; members that no position of the token allows a link are left out; a group whose
remaining members are of one component is done, and the others get more pivots.  At the end every
candidate pair has been compared or lies within one component, so components are exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlift.llm.bitmaps import Bitmap
from cohortlift.llm.components import components
from cohortlift.llm.words import mix, shingle_sets, text_slices
from cohortlift.llm.staging import Stages, small_batches
from cohortlift.operators.pinning import stage

#: Counters of the frequency sketch: 16 a document, so that its errors do not grow with the
#: corpus, within these bounds.
SKETCH_LEAST, SKETCH_MOST = 1 << 18, 1 << 25
_SKETCH_BLOCK = 1 << 16
#: Text that a task has in numpy at once; the arrays of a slice take many times its bytes.
_SLICE = 1 << 18
#: Copies from which a class is dealt over ``SALTS`` tasks where it is joined.
LARGE_CLASS, SALTS = 512, 32
_SEEDS = tuple(np.uint64(s) for s in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0))

_SKETCH_SCHEMA = "block int, counts binary"
_FEATURE_SCHEMA = "doc_id long, n_shingles long, key_a long, key_b long, prefix array<long>"
_BODY_SCHEMA = "doc_id long, second array<int>, third array<int>, text string"


def _sketch_part(width: int, slots: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, dtype=np.int32)
        for batch in batches:
            for texts in text_slices(batch.column("text"), _SLICE):
                sets = list(shingle_sets(texts, width))
                tokens = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                np.add.at(counts, (tokens & np.uint64(slots - 1)).astype(np.int64), 1)
        yield from _blocks(counts)

    return count


def _blocks(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = counts.reshape(-1, _SKETCH_BLOCK)
    keep = [i for i in range(len(parts)) if parts[i].any()]
    yield pa.RecordBatch.from_pydict({
        "block": pa.array(keep, pa.int32()),
        "counts": pa.array([zlib.compress(parts[i].tobytes(), 1) for i in keep], pa.binary()),
    })


def _sketch_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(zlib.decompress(counts), dtype=np.int32).astype(np.int64)
            sums[block] = sums[block] + part if block in sums else part
    yield pa.RecordBatch.from_pydict({
        "block": pa.array(sums, pa.int32()),
        "counts": pa.array([zlib.compress(np.minimum(v, 2**31 - 1).astype(np.int32).tobytes(), 1) for v in sums.values()], pa.binary()),
    })


def _slots_for(n: int) -> int:
    return min(max(1 << max(16 * n - 1, 1).bit_length(), SKETCH_LEAST), SKETCH_MOST)


def _gathered(parts: DataFrame, slots: int) -> np.ndarray:
    """The sum of all tasks' counters, summed block by block before they reach the driver."""
    counts = np.zeros((slots // _SKETCH_BLOCK, _SKETCH_BLOCK), dtype=np.int32)
    for row in parts.repartition("block").mapInArrow(_sketch_sum, _SKETCH_SCHEMA).toLocalIterator():
        counts[row.block] = np.frombuffer(zlib.decompress(row.counts), dtype=np.int32)
    return counts.reshape(-1)


def frequency_classes(docs: DataFrame, width: int) -> np.ndarray:
    """For each sketch slot, how rare its tokens are: 0 up to the mean count of a slot, then a class for
    every quarter of a doubling of the standard errors above it.

    The sketch is bounded by ``SKETCH_MOST`` counters whatever the input, so it may pass through the driver.
    """
    slots = _slots_for(docs.select("doc_id").count())
    counts = _gathered(docs.select("text").mapInArrow(_sketch_part(width, slots), _SKETCH_SCHEMA), slots)
    mean = float(counts.mean())
    above = np.maximum(counts - np.float32(mean), np.float32(0)) / np.float32((mean + 1) ** 0.5)
    return np.minimum(np.floor(4 * np.log2(1 + above)), 63).astype(np.uint8)


def _ordered(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """Tokens as keys that sort by the given global order: 6 bits of class, 57 bits of hash."""
    level = classes[(tokens & np.uint64(len(classes) - 1)).astype(np.int64)].astype(np.uint64)
    return (level << np.uint64(57)) | (mix(tokens ^ _SEEDS[order]) >> np.uint64(7))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _features(width: int, num: int, den: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)
        for batch in batches:
            ids = batch.column("doc_id")
            for texts in text_slices(batch.column("text"), _SLICE):
                sets = list(shingle_sets(texts, width))
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                tokens = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                ends = np.cumsum(sizes)
                low, high = np.zeros((2, len(sets)), dtype=np.uint64)
                filled = np.flatnonzero(sizes)
                if len(filled):
                    at = (ends - sizes)[filled]
                    low[filled] = np.add.reduceat(mix(tokens ^ np.uint64(0x452821E638D01377)), at)
                    high[filled] = np.add.reduceat(mix(tokens ^ np.uint64(0xBE5466CF34E90C6C)), at)
                prefixes = _prefixes(tokens, sizes, classes, 0, num, den)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(texts.first, texts.rows), pa.array(sizes), pa.array(low.view(np.int64)),
                     pa.array(high.view(np.int64)), _lists(prefixes, pa.int64())],
                    names=["doc_id", "n_shingles", "key_a", "key_b", "prefix"],
                )

    return run


def _prefixes(
    tokens: np.ndarray, sizes: np.ndarray, classes: np.ndarray, order: int, num: int, den: int
) -> list[np.ndarray]:
    """The first ``n - ceil(t n) + 1`` keys of each set, ascending under the given order."""
    keys = _ordered(tokens, classes, order).astype(np.int64)
    take = np.where(sizes > 0, sizes - (num * sizes + den - 1) // den + 1, 0)
    parts = []
    for end, size, few in zip(np.cumsum(sizes).tolist(), sizes.tolist(), take.tolist()):
        part = keys[end - size : end]
        parts.append(np.sort(np.partition(part, few - 1)[:few]) if 0 < few < size else np.sort(part))
    return parts


def _bodies(width: int, num: int, den: int, shared):
    """The texts of wanted documents with their prefixes under the second and third order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)
        for batch in batches:
            for texts in text_slices(batch.column("text"), _SLICE):
                sets = list(shingle_sets(texts, width))
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                tokens = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                others = [
                    _lists([(p & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
                            for p in _prefixes(tokens, sizes, classes, order, num, den)], pa.int32())
                    for order in (1, 2)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(texts.first, texts.rows), *others,
                     batch.column("text").slice(texts.first, texts.rows)],
                    names=["doc_id", "second", "third", "text"],
                )

    return run


def _verify(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                left = [s for texts in text_slices(part.column("text_u"), _SLICE) for s in shingle_sets(texts, width)]
                right = [s for texts in text_slices(part.column("text_v"), _SLICE) for s in shingle_sets(texts, width)]
                for a, b in zip(left, right):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    linked.append(both > 0 and den * both >= num * (len(a) + len(b) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("u").filter(keep), batch.column("v").filter(keep)], names=["u", "v"]
            )

    return run


def _pairs(rows: DataFrame, spread: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pivots of each group (the highest-ranked node under each of ``spread`` salts), and their pairs
    with members of other components that the positions of the shared token do not rule out."""
    salt = F.pmod(F.xxhash64("node"), F.lit(spread))
    pivots = rows.groupBy("token", salt.alias("salt")).agg(F.max_by("node", F.struct("rank", "node")).alias("node")).drop("salt")
    left = rows.join(pivots, ["token", "node"]).select(
        "token", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("pos").alias("pp"),
        F.col("component").alias("pc"),
    )
    near = F.least(F.col("n") - F.col("pos"), F.col("pn") - F.col("pp")) * (num + den) >= (
        F.col("n") + F.col("pn")
    ) * num
    pairs = rows.join(left, "token").where((F.col("component") != F.col("pc")) & near)
    pairs = pairs.select(F.least("node", "p").alias("u"), F.greatest("node", "p").alias("v")).distinct()
    return pivots, pairs


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with ``rank``: how many documents a node's prefix tokens are shared with on average, so
    that the least edited of a group of near copies comes first; a hash breaks ties."""
    length = F.max("n") - F.max("floor") + 1
    hubs = rows.groupBy("node").agg(
        (F.sum("holders") / length + F.pmod(F.xxhash64("node"), F.lit(1 << 20)) * 1e-9).alias("rank")
    )
    return rows.join(hubs, "node").drop("holders", "floor")


def _open(rows: DataFrame, num: int, den: int, tables: Stages) -> DataFrame:
    """Rows that may still link: of groups with more than one component, once members are left out
    whose token lies too far behind even for the group's smallest set."""
    least = rows.groupBy("token").agg(F.min("n").alias("least"))
    allowed = (F.col("n") - F.col("pos")) * (num + den) >= (F.col("n") + F.col("least")) * num
    rows = tables.write(rows.join(least, "token").where(allowed).drop("least"), "allowed")
    several = rows.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("token")
    return tables.write(rows.join(several, "token"), "open")


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every row of ``docs``.

    Words are runs other than 0x20 and 0x09 to 0x0D with A-Z lower-cased; a document's set is its
    distinct ``width``-word shingles, or its whole sequence if it has fewer words.  Two documents link
    when their sets' similarity is at least ``num / den``.  ``class_id`` is the least doc_id of an
    equal set, ``component_id`` the least doc_id reachable by links.

    Null or word-less texts have an empty set and are linked with nothing.  Rows with the same
    doc_id count as one document.  A null doc_id takes part in no link and has null ids.  Equal
    texts always share a class.  Extra columns are ignored; an empty table gives an empty result.
    """
    # All that goes through Python is computed in this call; the result is read and joined in the JVM.
    with small_batches(docs.sparkSession):
        return _components(docs, width, num, den)


def _components(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    spark = docs.sparkSession
    tables = Stages(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(zlib.compress(frequency_classes(docs, width).tobytes(), 1))
    features = tables.write(docs.mapInArrow(_features(width, num, den, shared), _FEATURE_SCHEMA), "shingles")

    # Copies are one node; the sets' sizes and two 64-bit sums tell them apart from all other sets.
    key = ["n_shingles", "key_a", "key_b"]
    linkable = features.where("n_shingles > 0 and doc_id is not null")
    classes = tables.write(
        linkable.groupBy(*key).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")), "class-keys")
    large = Bitmap(classes.where(F.col("copies") >= LARGE_CLASS), *key)
    salted = _spread(large.marked(linkable.select("doc_id", *key), "_large", *key), "doc_id")
    members = salted.join(_repeated(large.marked(classes, "_large", *key)), [*key, "_salt"])
    alone = features.where("n_shingles = 0 or doc_id is null")
    members = stage(
        members.select("doc_id", "n_shingles", "class_id").unionByName(
            alone.select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"))), "classes",
    )
    heads = linkable.join(
        classes.withColumnRenamed("class_id", "doc_id"), ["doc_id", *key], "left_semi"
    )
    tokens = heads.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"),
                          F.posexplode("prefix").alias("pos", "token"))
    shared_tokens = tokens.groupBy("token").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("holders")
    ).where("low < high").select("token", "holders")
    floor = F.ceil(F.col("n") * num / den)
    rows = tables.write(
        tokens.join(shared_tokens, "token").select(
            "token", "node", "n", "pos", F.col("node").alias("component"), "holders", floor.alias("floor")
        ), "prefixes",
    )
    rows = tables.write(_ranked(rows), "ranked")
    # Rows of one doc_id with different texts are links by definition.
    mixed = members.groupBy("doc_id").agg(
        F.min("class_id").alias("v"), F.max("class_id").alias("high")
    ).where("v < high")
    edges = members.join(mixed, "doc_id").select(F.col("class_id").alias("u"), "v")
    found = components(edges)
    checked, spread = None, 1
    while not rows.isEmpty():
        pivots, pairs = _pairs(rows, spread, num, den)
        pairs = tables.write(pairs if checked is None else pairs.join(checked, ["u", "v"], "left_anti"), "candidates")
        checked = pairs if checked is None else checked.unionByName(pairs)
        # Only texts that a pair asks for leave the JVM, and none is shuffled to find them.
        asked = tables.write(
            pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id"))).distinct(), "asked")
        wanted = Bitmap(asked, "doc_id").marked(docs.where("doc_id is not null"), "_wanted", "doc_id")
        bodies = wanted.where("_wanted").drop("_wanted").mapInArrow(_bodies(width, num, den, shared), _BODY_SCHEMA)
        links = tables.write(_links(pairs, tables.write(bodies, "bodies"), width, num, den), "verified")
        tables.drop("bodies")
        if not links.isEmpty():
            # A node and its component are a link as good as those it was found by.
            forest = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
            found = components(forest.unionByName(links))
        left = rows.drop("component").join(pivots, ["token", "node"], "left_anti").join(
            found.withColumnRenamed("component", "root"), "node", "left"
        ).withColumn("component", F.coalesce("root", "node")).drop("root")
        rows = _open(left, num, den, tables)
        spread *= 64
    # Classes of many copies are dealt over several tasks again.
    heads = stage(classes.where(F.col("copies") >= LARGE_CLASS).select("class_id"), "large-classes")
    tables.drop()  # the result reads the classes and components alone
    large = Bitmap(heads, "class_id", seed=1)
    roots = found.select(F.col("node").alias("class_id"), F.col("component").alias("root"))
    return _spread(large.marked(members, "_large", "class_id"), "doc_id").join(
        _repeated(large.marked(roots, "_large", "class_id")), ["class_id", "_salt"], "left"
    ).select("doc_id", "n_shingles", "class_id", F.coalesce("root", "class_id").alias("component_id"))


def _spread(rows: DataFrame, by: str) -> DataFrame:
    """Rows with ``_salt``: 0, or one of ``SALTS`` for those that ``_large`` marks."""
    return rows.withColumn("_salt", F.when(F.col("_large"), F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(F.lit(0)).cast("long")).drop("_large")


def _repeated(rows: DataFrame) -> DataFrame:
    """The other side of such a join: a marked row stands once under each salt."""
    salts = F.when(F.col("_large"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_salt", F.explode(salts.cast("array<bigint>"))).drop("_large")


def _links(pairs: DataFrame, bodies: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Pairs whose prefixes meet under the other orders too and whose whole texts are alike."""
    def side(name: str, *columns: str) -> DataFrame:
        return bodies.select(F.col("doc_id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))

    kept = pairs.join(side("u", "second", "third"), "u").join(side("v", "second", "third"), "v").where(
        F.arrays_overlap("second_u", "second_v") & F.arrays_overlap("third_u", "third_v")
    ).select("u", "v").distinct()
    texts = kept.join(side("u", "text"), "u").join(side("v", "text"), "v").select("u", "v", "text_u", "text_v")
    return texts.mapInArrow(_verify(width, num, den), "u long, v long").distinct()
