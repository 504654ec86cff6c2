"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two models, toxic and ordinary, give every byte of a word (and the word's end) a probability after up to
``ORDER - 1`` bytes of the word before it: discounted counts of the class, the rest of the mass handed to
a model that both share.  The shared model is an interpolated Kneser-Ney model of the pooled rows: its
shorter contexts count distinct left neighbours.  So what one class has hardly met is judged by
what both have met, and differences come from contexts that a class knows well.  A document's score is the difference of its log-likelihoods per byte, put on a scale of 0
to 1 by a logistic fit on labelled rows that the counts have not seen.

The models are Spark tables keyed by the exact n-gram, so they grow with the counts and share nothing.
The scored documents' distinct n-grams are joined to them.  The differences of the most frequent
ones go to the tasks; words that hold any other are exploded to n-grams, joined by shuffle, and summed
by word, then by document.  Differences are whole multiples of 1 / ``UNIT``, so that sums do not
depend on their order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlift.llm.words import Texts, text_slices
from cohortlift.operators.pinning import stage, stage_union

ORDER = 5
DISCOUNT = 0.75
#: A word whose two log-likelihoods differ by more nats than this is told apart.  Most words are not,
#: and their many small differences would drown the few that are.
MARGIN = 4.0
#: The scale is fitted on about this many labelled documents at most, chosen by a hash; counts use all others.
MAX_SCALE_DOCS = 20_000
_SCALE_TENTHS = 2

_BEGIN, _END = 1, 2  # bytes that do not occur in words
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
#: Parts of a nat in which differences are summed.
UNIT = 1 << 24
#: The most frequent n-grams, whose differences go to the tasks; all others are joined by shuffle.
COMMON_GRAMS = 1 << 18
_CACHE = 1 << 20
_CLASS_PART = 2 * ORDER + 2
#: Sizes whose look-ups are planned as one query; the driver's memory for a plan grows faster than its joins.
_JOINED_SIZES = 2
#: Text counted at a time; a worker holds some 100 times as much.
_COUNTED_BYTES = 1 << 20


def _events(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes between marks, the place of each byte in its word, and where each word begins."""
    sizes = ends - starts + 2
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    source = np.repeat(starts - 1, sizes) + place
    out = np.full(len(place), _END, dtype=np.uint64)
    inner = (place > 0) & (place < np.repeat(sizes, sizes) - 1)
    out[inner] = _FOLD[texts.data[source[inner]]]
    out[first] = _BEGIN
    return out, place, first


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` bytes up to each place as one number; those that reach over a word's start are void."""
    out = np.zeros(len(codes), dtype=np.uint64)
    for back in range(order):
        shifted = np.zeros(len(codes), dtype=np.uint64)
        shifted[back:] = codes[: len(codes) - back] if back else codes
        out |= shifted << np.uint64(8 * back)
    return out


def _longest_grams(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The longest n-gram up to each place but a word's first, its length in the top byte."""
    top = np.zeros(len(codes), dtype=np.uint64)
    for order in range(2, ORDER + 1):
        mine = np.minimum(place + 1, ORDER) == order
        top[mine] = _grams(codes, order)[mine] | np.uint64(order << 56)
    return top


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each longest n-gram occurs by label; ``gram`` holds its length in the top byte."""
    for batch in batches:
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        for texts in text_slices(batch.column("text"), _COUNTED_BYTES):
            starts, ends, first_word = texts.spans()
            row = np.repeat(np.arange(texts.rows), np.diff(first_word))
            label = labels[texts.first : texts.first + texts.rows][row].astype(np.uint64)
            hashes = texts.word_hashes(starts, ends) ^ label
            _, at, times = np.unique(hashes, return_index=True, return_counts=True)
            codes, place, first = _events(texts, starts[at], ends[at])
            word = np.repeat(np.arange(len(at)), np.diff(np.append(first, len(codes))))
            top = _longest_grams(codes, place)
            use = place > 0
            key = (top[use] << np.uint64(1)) | label[at][word[use]]
            key, back = np.unique(key, return_inverse=True)
            count = np.bincount(back, weights=times[word[use]]).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "label": pa.array((key & np.uint64(1)).astype(np.int32)),
                "gram": pa.array((key >> np.uint64(1)).view(np.int64)), "times": pa.array(count),
            })


def _levels(grams: DataFrame) -> list[DataFrame]:
    """(gram, times) of the pooled rows for each order from the longest: raw counts of the longest
    n-grams and of those at a word's start, numbers of distinct left neighbours otherwise."""
    pooled = stage(grams.groupBy("gram", "order").agg(F.sum("times").alias("times")), "pooled")
    levels = [pooled.where(F.col("order") == ORDER).select("gram", "times")]
    for size in range(ORDER - 1, 0, -1):
        shorter = levels[-1].select(
            F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1)).alias("gram"), F.lit(1).cast("long").alias("times")
        )
        anchored = pooled.where(F.col("order") == size).select("gram", "times")
        # Each level is read by three tables and the next level, which would all plan it anew.
        levels.append(stage(shorter.unionByName(anchored).groupBy("gram").agg(F.sum("times").alias("times")), "level"))
    return levels


def _shares(level: DataFrame, by: list[str], part: Column, rest_part: Column, context: Column) -> list[DataFrame]:
    """Discounted share of each n-gram after its context, and each context's left-over mass."""
    level = level.withColumn("context", context)
    totals = level.groupBy(*by, "context").agg(F.sum("times").alias("total"), F.count("*").alias("kinds"))
    return [
        level.join(totals, [*by, "context"]).select(
            part.cast("int").alias("part"), "gram", ((F.col("times") - DISCOUNT) / F.col("total")).alias("value"),
        ),
        totals.select(
            rest_part.cast("int").alias("part"), F.col("context").alias("gram"),
            (F.lit(DISCOUNT) * F.col("kinds") / F.col("total")).alias("value"),
        ),
    ]


def _body(gram: Column) -> Column:
    """The bytes of an n-gram that holds its length in the top byte."""
    return gram.bitwiseAND(F.lit((1 << 56) - 1))


def _longest_context(gram: Column) -> Column:
    """The context of a longest n-gram, with the n-gram's length in the top byte."""
    return F.shiftright(_body(gram), 8).bitwiseOR(F.shiftleft(F.shiftright(gram, 56), 56))


def _tables(grams: DataFrame) -> DataFrame:
    """(part, gram, value), one row for each exact n-gram or context, written.  Part ``2 * size`` holds the
    pooled model's shares of that order and the part after it the left-over masses; from
    ``_CLASS_PART`` on come both classes' shares and masses, with the length in the top byte."""
    parts = _shares(
        grams.select("label", "gram", "times"), ["label"],
        F.lit(_CLASS_PART) + F.col("label"), F.lit(_CLASS_PART + 2) + F.col("label"), _longest_context(F.col("gram")),
    )
    bodies = grams.select(_body(F.col("gram")).alias("gram"), F.shiftright("gram", 56).alias("order"), "times")
    for size, level in zip(range(ORDER, 0, -1), _levels(bodies)):
        parts += _shares(level, [], F.lit(2 * size), F.lit(2 * size + 1), F.shiftright("gram", 8))
    return stage_union(parts, "tables", "part")


@dataclass
class Model:
    """Both classes' tables, partitioned by part, and the weights of the scale."""

    tables: DataFrame
    scale: np.ndarray


def _gains(grams: DataFrame, tables: DataFrame) -> DataFrame:
    """``grams`` with ``gain``: the log-likelihood under the toxic model less that under the ordinary one.

    At most 256 n-grams share a long context or ending, and tables of short ones are small, so no key is hot.
    """
    def look_up(rows: DataFrame, names: dict[int, str], gram: Column, missing: float) -> DataFrame:
        held = tables.where(F.col("part").isin(*names)).select(F.col("gram").alias("_key"), "part", "value")
        if len(names) == 1:
            held = held.select("_key", *(F.col("value").alias(name) for name in names.values()))
        else:
            held = held.groupBy("_key").agg(
                *(F.max(F.when(F.col("part") == part, F.col("value"))).alias(name) for part, name in names.items()))
        found = rows.withColumn("_at", gram).join(held, F.col("_at") == F.col("_key"), "left").drop("_at", "_key")
        return found.withColumns({name: F.coalesce(name, F.lit(missing)) for name in names.values()})

    rows, length = grams.withColumn("_chance", F.lit(1 / 256)), F.shiftright("gram", 56)
    for size in range(1, ORDER + 1):
        ending = F.when(length >= size, F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1)))
        rows = look_up(rows, {2 * size: "_share"}, ending, 0.0)
        rows = look_up(rows, {2 * size + 1: "_rest"}, F.shiftright(ending, 8), 1.0)
        rows = rows.select(*grams.columns, (F.col("_share") + F.col("_rest") * F.col("_chance")).alias("_chance"))
        if size % _JOINED_SIZES == 0:
            rows = stage(rows, "chances")
    rows = look_up(rows, {_CLASS_PART + label: f"_share_{label}" for label in (0, 1)}, F.col("gram"), 0.0)
    rows = look_up(rows, {_CLASS_PART + 2 + label: f"_rest_{label}" for label in (0, 1)}, _longest_context(F.col("gram")), 1.0)
    ordinary, toxic = (F.ln(F.col(f"_share_{label}") + F.col(f"_rest_{label}") * F.col("_chance")) for label in (0, 1))
    return rows.select(*grams.columns, F.round((toxic - ordinary) * UNIT).cast("long").alias("gain"))


class _Words:
    """Differences of words from those of common n-grams, and of the words met so far."""

    def __init__(self, grams: np.ndarray, gains: np.ndarray) -> None:
        self.grams, self.gains = grams, gains
        self.keys = np.zeros(_CACHE, dtype=np.uint64)
        self.values = np.zeros(_CACHE, dtype=np.int64)

    def _fresh(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each word's sum over common n-grams, and its other n-grams: their words and themselves."""
        codes, place, first = _events(texts, starts, ends)
        grams = _longest_grams(codes, place).view(np.int64)
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            here = self.grams[at] == grams
            gain = np.where(here, self.gains[at], 0)
        else:
            here, gain = np.zeros((2, len(grams)), dtype=np.int64)
        here[first], gain[first] = 1, 0
        other = np.flatnonzero(here == 0)
        word = np.searchsorted(first, other, side="right") - 1
        return np.add.reduceat(gain, first), word, grams[other]

    def sums(self, texts: Texts) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """For each row the summed difference, that of the words told apart, and how many bytes and word
        ends the sums are over, all without words of other n-grams; and these words' n-grams."""
        starts, ends, first_word = texts.spans()
        hashes = texts.word_hashes(starts, ends)
        at = (hashes & np.uint64(_CACHE - 1)).astype(np.int64)
        gain, open_words = self.values[at], {n: np.zeros(0, dtype=np.int64) for n in ("row", "word", "times", "copies", "sum", "gram")}
        missing = np.flatnonzero(self.keys[at] != hashes)
        if len(missing):
            fresh, one, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            found, word, gram = self._fresh(texts, starts[missing[one]], ends[missing[one]])
            whole = np.ones(len(fresh), dtype=bool)
            whole[word] = False
            gain[missing] = np.where(whole, found, 0)[back]
            into = (fresh[whole] & np.uint64(_CACHE - 1)).astype(np.int64)
            self.keys[into], self.values[into] = fresh[whole], found[whole]
            if len(word):
                used = np.flatnonzero(~whole[back])
                row = np.searchsorted(first_word, missing[used], side="right") - 1
                pair, times = np.unique(row * len(fresh) + back[used], return_counts=True)
                row, of = pair // len(fresh), pair % len(fresh)
                begin, upto = np.searchsorted(word, of), np.searchsorted(word, of, side="right")
                many = upto - begin
                inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                # A word's sum over common n-grams travels with the first of its others.
                open_words = {
                    "row": np.repeat(row, many), "word": np.repeat(fresh[of].view(np.int64), many), "times": np.repeat(times, many),
                    "copies": (inner == 0).astype(np.int64), "sum": np.where(inner == 0, np.repeat(found[of], many), 0), "gram": gram[np.repeat(begin, many) + inner],
                }
        clear = np.where(gain > int(MARGIN * UNIT), gain, 0)
        return np.stack([
            np.diff(np.concatenate([[0], np.cumsum(part)])[first_word]) for part in (gain, clear, ends - starts + 1)
        ]), open_words


def _differences(docs: DataFrame, tables: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every row with the summed difference, that of the words told apart, and how many
    bytes and word ends the sums are over.

    Rows equal in ``columns`` and text are summed as one and come out as many times as they went in.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    held = docs.select("text", F.lit(0).alias("label")).mapInArrow(_counts, "label int, gram long, times long").groupBy("gram").agg(
        F.sum("times").alias("held"))
    gains = stage(_gains(held, tables), "gains")
    common = gains.orderBy(F.col("held").desc(), "gram").limit(COMMON_GRAMS).select("gram", "gain").toArrow().sort_by("gram")
    shared = docs.sparkSession.sparkContext.broadcast(tuple(common.column(c).to_numpy() for c in ("gram", "gain")))
    numbers = ["word", "times", "sum", "gram", "copies", "own", "told", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(*shared.value)
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                found, others = words.sums(texts)
                kept = batch.select([*columns, "mark"]).slice(texts.first, texts.rows)
                place = pa.array(np.concatenate([np.arange(texts.rows), others["row"]]).astype(np.int64))
                none, void = np.zeros(texts.rows, dtype=np.int64), np.zeros(len(others["row"]), dtype=np.int64)
                # A document's own row joins under its mark, which spreads such rows, and uses no n-gram.
                mark = kept.column("mark").to_numpy()
                own = {"word": none, "times": none, "sum": none, "gram": mark, "copies": none + 1}
                values = [np.concatenate([own[n], others[n]]) for n in own]
                values += [np.concatenate([v, void]) for v in found]
                yield pa.RecordBatch.from_arrays(
                    [*kept.take(place).columns, *(pa.array(v.astype(np.int64)) for v in values)], names=[*columns, "mark", *numbers])

    marked = docs.select(*columns, F.xxhash64("text").alias("mark"), "text")
    uses = marked.mapInArrow(run, f"{schema}, mark long, " + ", ".join(f"{n} long" for n in numbers))
    rows = uses.join(gains.select("gram", "gain"), "gram", "left").repartition(*columns, "mark")
    gain = F.col("sum") + F.when(F.col("times") > 0, F.col("gain")).otherwise(0)
    words = rows.groupBy(*columns, "mark", "word", "times").agg(
        F.sum(gain).alias("gain"), *(F.sum(c).alias(c) for c in ("copies", "own", "told", "bytes"))
    ).select(*columns, "mark", "copies", "times", *(F.expr(f"{c} div copies").alias(c) for c in ("gain", "own", "told", "bytes")))
    more = F.col("times") * F.col("gain")
    sums = words.groupBy(*columns, "mark").agg(
        F.max(F.when(F.col("times") == 0, F.col("copies"))).alias("copies"), F.sum(F.col("own") + more).alias("own"),
        F.sum(F.col("told") + F.when(F.col("gain") > int(MARGIN * UNIT), more).otherwise(0)).alias("told"), F.sum("bytes").alias("bytes"),
    )
    each = sums.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        *columns, (F.col("own") / UNIT).alias("difference"), (F.col("told") / UNIT).alias("clear"), F.col("bytes").alias("length"))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _xxhash64(values: np.ndarray) -> np.ndarray:
    """The public 64-bit xxHash of single longs with seed 42, as Spark's xxhash64 gives it."""
    def rotate(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    h = np.full(len(values), np.uint64(42)) + _P5 + np.uint64(8)
    h ^= rotate(values * _P2, 31) * _P1
    h = rotate(h, 27) * _P1 + _P4
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    return h ^ (h >> np.uint64(32))


def _scale_terms(sums: np.ndarray, clear: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    size = np.maximum(sizes, 1)
    return np.stack([
        10 * sums / size, np.log1p(1000 * clear / size), np.log1p(clear), np.log(size) / 5, np.ones(len(size)),
    ], axis=1)


def _fit_scale(differences: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps with a small ridge."""
    x = _scale_terms(*differences)
    weights = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - labels) + 1e-2 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(labelled: DataFrame) -> Model | None:
    """A model from rows of doc_id, text and label (0 or 1); None unless both labels occur.

    All rows but those of the scale are counted.  Counting is a map-side-combined aggregation, and its
    tables stay with the executors; what passes through the driver are the scale's few sums.
    """
    rows = labelled.where("doc_id is not null and label in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("label").cast("int").alias("label"),
    )
    kinds = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit("scale")), F.lit(1_000_000))
    share = int(1e6 * min(_SCALE_TENTHS / 10, MAX_SCALE_DOCS / sum(kinds.values())))
    counted = rows.where(draw >= share).select("text", "label")
    grams = counted.mapInArrow(_counts, "label int, gram long, times long").groupBy("label", "gram").agg(
        F.sum("times").alias("times"))
    tables = _tables(stage(grams, "counts"))
    seen = _differences(rows.where(draw < share), tables, ["doc_id", "label"]).toArrow()
    if len(set(seen.column("label").to_pylist())) < 2:  # too small a table to fit a scale on
        return Model(tables, np.array([1.0, 0.0, 0.0, 0.0, 0.0]))
    seen = seen.sort_by([(c, "ascending") for c in seen.column_names])
    found = np.stack([seen.column(c).to_numpy().astype(float) for c in ("difference", "clear", "length")])
    return Model(tables, _fit_scale(found, seen.column("label").to_numpy().astype(float)))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, difference, clear, length, score) of every row; score 0.5 without a model.

    Null texts are scored as empty ones; any doc_id, null or repeated, keeps its row; extra columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("difference"), F.lit(0.0).alias("clear"), F.lit(0).cast("long").alias("length"), F.lit(0.5).alias("score"))
    size = F.greatest("length", F.lit(1))
    terms = [10 * F.col("difference") / size, F.log1p(1000 * F.col("clear") / size), F.log1p("clear"), F.ln(size) / 5, F.lit(1.0)]
    z = sum((term * float(weight) for term, weight in zip(terms, model.scale)), F.lit(0.0))
    found = _differences(docs, model.tables, ["doc_id"])
    return found.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0)))))
