"""Document fingerprints by consistent weighted sampling, in DataFrame expressions only.

A text is a set of words weighted by how often they occur.  For every slot of a signature and every word
two Gamma(2, 1) draws r and c and one uniform draw b come from one hash of (word, slot); with weight S

    t = floor(ln S / r + b),   ln a = ln c - r (t - b + 1)

and the slot keeps the (word, t) of least a.  Two texts agree in a slot with a probability equal to their
generalised Jaccard similarity, sum of lesser weights over sum of greater ones, so the share of agreeing
slots estimates it without bias.  A slot travels as one long, quantised ln a above a 32-bit
hash of (word, t), so that the least is found by ``min`` and words never leave their row.

Draws are read from tables of the Gamma distribution's quantiles, which spares three logarithms a slot.  A
document and its edited text are signed together: a word that both hold is drawn for once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlift.operators.pinning import pin, stage

SLOTS = 64
#: Slots folded by one row of the generator.  More in one expression outgrow the JVM's compiler.
LANE = 2
#: Documents in a shard, shards in a task, and shards at most; beyond 2^28 documents shards grow.
SHARD_ROWS, TASK_SHARDS, MAX_SHARDS = 1024, 4, 1 << 18
#: Bits of the hash that draw r and c; the other 28 draw b.
_R_BITS, _C_BITS = 12, 24


def _quantiles(u: np.ndarray) -> np.ndarray:
    """Where the Gamma(2, 1) distribution function, 1 - (1 + x) exp(-x), takes the values ``u``."""
    low, high = np.zeros(len(u)), np.full(len(u), 64.0)
    for _ in range(64):
        middle = (low + high) / 2
        below = -np.expm1(-middle) - middle * np.exp(-middle) < u
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


def _literal(values: Sequence, kind: str = "double") -> Column:
    """Numbers as one constant; Spark folds the text away before anything runs."""
    texts = (f"{v:.12g}" if kind == "double" else str(v) for v in values)
    return F.expr("cast(split('{}', ' ') as array<{}>)".format(" ".join(texts), kind))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """r by 12 bits, and ln c by 24 bits: four tables of 4096, each for a sixteenth of the one before, since
    the least of many draws lies far down the distribution."""
    cells = np.arange(1 << _R_BITS) + 0.5
    r = _quantiles(cells / (1 << _R_BITS))
    return r, np.log(np.concatenate([_quantiles(cells / (1 << _R_BITS) / 16.0**level) for level in range(4)]))


def _draws(k: int) -> dict[str, Column]:
    """``_r``, 1 / r, ln c and b of slot ``k`` of a lane from its hash."""
    r, log_c = _tables()
    hashed = F.col(f"_x{k}")
    cell = hashed.bitwiseAND(F.lit((1 << _R_BITS) - 1)).cast("int")
    u = F.col(f"_u{k}")
    place = (
        F.when(u >= 1 << 20, F.shiftright(u, 12)).when(u >= 1 << 16, F.shiftright(u, 8) + 4096)
        .when(u >= 1 << 12, F.shiftright(u, 4) + 8192).otherwise(u + 12288)
    )
    return {
        f"_r{k}": F.get(_literal(r), cell), f"_q{k}": F.get(_literal(1 / r), cell), f"_c{k}": F.get(_literal(log_c), place),
        f"_b{k}": (F.shiftrightunsigned(hashed, _R_BITS + _C_BITS).cast("double") + F.lit(0.5)) * F.lit(2.0**-28),
    }


def _count(log: str, k: int) -> Column:
    """t of slot ``k`` for a word of log weight ``log``."""
    return F.floor(F.col(log) * F.col(f"_q{k}") + F.col(f"_b{k}"))


def _value(t: str, k: int) -> Column:
    """A slot's value: quantised ln a above the mark of (word, t)."""
    log_a = F.col(f"_c{k}") - F.col(f"_r{k}") * (F.col(t) - F.col(f"_b{k}") + 1)
    mark = (F.shiftrightunsigned("_word", 31) + F.col(t) * F.lit(0x9E3779B1)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.floor(log_a * F.lit(float(1 << 20))) * F.lit(1 << 32) + mark


def words(text: str) -> Column:
    """The words of a text column as an array, with empty strings among them; separators are 0x20 and 0x09 to 0x0D."""
    clean = F.coalesce(F.col(text), F.lit(""))
    for separator in "\t\n\x0b\x0c\r":
        clean = F.replace(clean, F.lit(separator), F.lit(" "))
    return F.split(clean, " ")


def signatures(texts: DataFrame, keys: list[str], left: str, right: str, slots: int = SLOTS) -> DataFrame:
    """``keys``, ``own`` and ``other``: the marks of both texts of a row, null for a text without words.

    ``keys`` tell rows apart and should be few and short.  Words are counted and slots folded by aggregations by
    the keys: rows that are partitioned by one of them are not shuffled.
    """
    # One generator for both texts: the words from place ``_from`` on are the right one's.
    both = texts.select(*keys, words(left).alias("_left"), words(right).alias("_right"))
    both = both.select(*keys, F.size("_left").alias("_from"), F.concat("_left", "_right").alias("_all"))
    each = both.select(*keys, "_from", F.posexplode("_all").alias("_at", "_text"))
    # Empty strings come under a null word, which has no draws; so a row without words is not lost.
    named = each.select(*keys, (F.col("_at") < F.col("_from")).alias("_is_left"),
                        F.when(F.col("_text") != "", F.xxhash64("_text")).alias("_word"))
    terms = named.groupBy(*keys, "_word").agg(
        F.count(F.when(F.col("_is_left"), F.col("_word"))).alias("_n"), F.count(F.when(~F.col("_is_left"), F.col("_word"))).alias("_m")
    ).select(*keys, "_word", *(F.ln(F.nullif(n, F.lit(0)).cast("double")).alias(log) for n, log in (("_n", "_own"), ("_m", "_edit"))))
    lanes = terms.withColumn("_lane", F.explode(F.array(*(F.lit(k) for k in range(0, slots, LANE)))))
    # Step by step, so that no part of an expression is computed twice.
    lane = range(LANE)
    lanes = lanes.select("*", *(F.xxhash64("_word", F.col("_lane") + k).alias(f"_x{k}") for k in lane))
    lanes = lanes.select("*", *(
        F.shiftrightunsigned(f"_x{k}", _R_BITS).bitwiseAND(F.lit((1 << _C_BITS) - 1)).cast("int").alias(f"_u{k}") for k in lane))
    lanes = lanes.select("*", *(column.alias(name) for k in lane for name, column in _draws(k).items()))
    lanes = lanes.select("*", *(_count("_own", k).alias(f"_t{k}") for k in lane))
    lanes = lanes.select("*", *(_value(f"_t{k}", k).alias(f"_v{k}") for k in lane))
    same = F.col("_edit") == F.col("_own")
    lanes = lanes.select("*", *(F.when(same, F.col(f"_t{k}")).otherwise(_count("_edit", k)).alias(f"_e{k}") for k in lane))
    lanes = lanes.select("*", *(F.when(same, F.col(f"_v{k}")).otherwise(_value(f"_e{k}", k)).alias(f"_w{k}") for k in lane))
    folded = lanes.groupBy(*keys, "_lane").agg(
        *(F.min(f"_v{k}").alias(f"_own{k}") for k in lane), *(F.min(f"_w{k}").alias(f"_other{k}") for k in lane))

    def marks(side: str) -> Column:
        found = (F.shiftright(F.shiftleft(F.col(f"{side}{k}"), 32), 32).cast("int") for k in lane)
        return F.when(F.col(f"{side}0").isNotNull(), F.array(*found))

    folded = folded.select(*keys, "_lane", marks("_own").alias("own"), marks("_other").alias("other"))
    whole = folded.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_lane", "own", "other"))).alias("_lanes"))
    return whole.select(*keys, *(F.flatten(F.transform("_lanes", lambda x: x[side])).alias(side) for side in ("own", "other")))


def fingerprint(slots: Column) -> Column:
    """Marks as hexadecimal text; empty for a text without words."""
    return F.coalesce(
        F.array_join(F.transform(slots, lambda s: F.lower(F.right(F.lpad(F.hex(s), 8, "0"), F.lit(8)))), ""), F.lit(""))


def likeness(left: str, right: str) -> Column:
    """Share of agreeing slots; two texts without words are alike, one such text is unlike all others."""
    agree = F.aggregate(
        F.zip_with(left, right, lambda a, b: (a == b).cast("int")), F.lit(0), lambda total, x: total + x
    )
    both = F.col(left).isNull() & F.col(right).isNull()
    return F.when(both, 1.0).otherwise(F.coalesce(agree / F.size(left), F.lit(0.0))).cast("double")


def _sharded(docs: DataFrame) -> DataFrame:
    """Documents with ``shard``: ranges of doc_id of about equal numbers of rows, a null doc_id in the first.

    A shard is found in two steps, among every so many bounds and then among those between.
    """
    n = docs.select("doc_id").count()
    shards = max(1, min(-(-n // SHARD_ROWS), MAX_SHARDS))
    if shards == 1:
        return docs.withColumn("shard", F.lit(0))
    cuts = _literal(np.arange(1, shards) / shards)
    bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", cuts, 10 * shards)).first()[0] or []))
    if not bounds:
        return docs.withColumn("shard", F.lit(0))
    wide = max(1, round(len(bounds) ** 0.5))
    heads, every = (_literal(b, "bigint") for b in (bounds[::wide], bounds))
    group = F.greatest(F.size(F.filter(heads, lambda b: b < F.col("doc_id"))) - 1, F.lit(0))
    among = F.slice(every, F.col("_group") * wide + 1, F.lit(wide))
    below = F.size(F.filter(among, lambda b: b < F.col("doc_id")))
    placed = docs.withColumn("_group", F.when(F.col("doc_id").isNotNull(), group).otherwise(0))
    shard = F.when(F.col("doc_id").isNotNull(), F.col("_group") * wide + below).otherwise(0)
    return placed.withColumn("shard", shard.cast("int")).drop("_group")


def with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, text, the text of the next document in descending doc_id order (after the last: the
    first), ``shard`` and ``place`` in it; and for every shard the text that follows its last document.

    A null doc_id comes last; equal doc_ids are ordered by text.
    """
    docs = _sharded(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ))
    heads = docs.groupBy("shard").agg(F.max("doc_id").alias("head"))
    around = Window.orderBy(F.col("shard").desc())
    heads = pin(heads.select(
        "shard", "head", F.lead("shard").over(around).alias("lower"),
        F.max("shard").over(Window.partitionBy(F.lit(0))).alias("top"),
    ).select(F.coalesce("lower", "top").alias("next_shard"), "shard", "head"))
    texts = docs.join(
        heads.select(F.col("shard").alias("hs"), "head"),
        (F.col("shard") == F.col("hs")) & F.col("doc_id").eqNullSafe(F.col("head")),
    ).groupBy("hs").agg(F.min("text").alias("head_text"))
    border = stage(
        heads.select("shard", "next_shard").join(texts, F.col("next_shard") == F.col("hs")).select(
            F.col("shard").alias("bs"), "next_shard", "head_text"
        ), "borders",
    )
    inside = Window.partitionBy("shard").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    # A number of tasks by rows: the work that follows grows with words, and would be dealt by bytes otherwise.
    tasks = -(-border.count() // TASK_SHARDS)
    rows = docs.repartition(max(tasks, 1), "shard").select(
        "doc_id", "text", "shard", F.row_number().over(inside).alias("place"),
        F.lead("text").over(inside).alias("after"),
    )
    # Only the last row of a shard takes the join's text; the borders have one row a shard.
    rows = rows.join(border, F.col("shard") == F.col("bs")).select(
        "doc_id", "text", "shard", "place", F.coalesce("after", "head_text").alias("next_text"))
    return rows, border.select(F.col("bs").alias("shard"), F.col("head_text").alias("text"))


def edited_fingerprints(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to each other and to
    the next document's.

    The edited text has the last half of the code points (rounded down) replaced by as many of the
    next document's first, or all it has.  Null texts are empty, with an empty fingerprint; repeated rows
    each keep their row; extra columns are ignored; an empty table gives an empty result.
    """
    rows, borders = with_next(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next_text"), half))
    rows = rows.select("shard", "place", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    found = signatures(rows, ["shard", "place"], "text", "edited", slots)
    # The next document stands next in the shard; after a shard's last one comes the head of another shard.
    heads = signatures(borders.withColumn("edited", F.lit("")), ["shard"], "text", "edited", slots)
    in_shard = Window.partitionBy("shard").orderBy("place")
    found = found.join(heads.select("shard", F.col("own").alias("head")), "shard").withColumns({
        "following": F.lead("own").over(in_shard), "is_last": F.lead("place").over(in_shard).isNull()
    }).withColumn("following", F.when(F.col("is_last"), F.col("head")).otherwise(F.col("following")))
    signed = found.select(
        "shard", "place", "own", "other", likeness("own", "other").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
    )
    # Both sides read one shuffle of the texts.
    about = rows.select("shard", "place", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    return about.join(signed, ["shard", "place"]).select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
