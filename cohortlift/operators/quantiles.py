"""Exact grouped quantiles that never gather a large group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from cohortlift.operators.pinning import pin

#: Size of the sketches, and how far off their ranks may be, as a share of the rows: about twice the
#: error that a sketch of this size stays within in 99 of 100 cases.
SKETCH_SIZE, RANK_SLACK = 4096, 0.0025
#: Ranks that a sketch is asked for; Spark wants them constant.
GRID = 400
_GRID = "cast(split('{}', ' ') as array<double>)".format(" ".join(str(cell / GRID) for cell in range(GRID + 1)))
#: Each narrowing keeps some 2 * RANK_SLACK + 2 / GRID of a bracket's rows; more than these would find ties only.
MOST_NARROWINGS = 6


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, prob: float, out: str,
    max_rows: int = 1_000_000, size: int = SKETCH_SIZE, slack: float = RANK_SLACK,
) -> DataFrame:
    """Linear-interpolation quantile of ``value`` per ``keys``, as one pinned row per group.

    Two reads of ``df``: a mergeable quantile sketch per group gives a bracket around the wanted order
    statistics, then the values inside are counted exactly with the number of rows below, and only the
    distinct ones among them are sorted.  A bracket of more than ``max_rows`` rows is narrowed first, by a read
    that counts below and sketches inside.  A bracket that misses (one in a hundred) is widened and read
    again.  Nulls are left out; NaN counts as greater than all numbers.
    """
    keys = list(keys)
    values = df.selectExpr(*keys, f"cast({value} as double) as _x").filter("_x is not null")
    sketch = f"kll_sketch_agg_double(if(isnan(_x), null, _x), {size})"
    # ``rank`` counts from 0 among the sketched rows; ``target`` among all of the group.
    spans = pin(
        values.groupBy(*keys).agg(F.count("*").alias("n"), F.expr(sketch).alias("sketch"))
        .selectExpr(*keys, "n", f"(n - 1) * {prob!r}D as target", "sketch", "0L as before", "n as inside")
    )
    spans = _bracketed(spans, keys, slack, "double('-infinity')", "double('NaN')")
    for _ in range(MOST_NARROWINGS):
        if not spans.filter(_wide(max_rows)).take(1):
            break
        spans = _narrowed(values, keys, spans, max_rows, sketch, slack)
    settled = []
    while True:
        found = pin(_settled(values, keys, spans))
        settled.append(found.filter("hit").selectExpr(*keys, f"if(frac = 0, a, a + (b - a) * frac) as {out}"))
        missed = found.filter("not hit")
        if not missed.take(1):
            break
        slack *= 8
        spans = _bracketed(spans.join(missed.select(*keys), keys), keys, slack, "double('-infinity')", "double('NaN')")
    return pin(reduce(lambda a, b: a.unionByName(b), settled)) if len(settled) > 1 else settled[0]


def _wide(max_rows: int) -> str:
    return f"expected > {max_rows} and not (lo <=> hi)"


def _bracketed(spans: DataFrame, keys: list[str], slack: float, least: str, most: str) -> DataFrame:
    """``lo`` and ``hi`` around the wanted order statistics, from a sketch of the ``inside`` rows that come
    after ``before`` others; the outer bounds where the slack reaches beyond the sketch."""
    common = [*keys, "n", "target", "sketch", "before", "inside"]
    ranked = spans.selectExpr(*common, "kll_sketch_get_n_double(sketch) as held").selectExpr(
        *common, "held",
        f"floor(((floor(target) - before + 0.5D) / nullif(held, 0) - {slack}D) * {GRID}) as low_cell",
        f"ceil(((floor(target) - before + 2.5D) / nullif(held, 0) + {slack}D) * {GRID}) as high_cell",
    ).selectExpr(*common, "low_cell", "high_cell", f"if(held > 0, kll_sketch_get_quantile_double(sketch, {_GRID}), null) as grid")
    return pin(
        ranked.selectExpr(
            *common,
            f"if(low_cell between 1 and {GRID}, grid[cast(low_cell as int)], {least}) as lo",
            f"if(high_cell between 0 and {GRID - 1}, grid[cast(high_cell as int)], {most}) as hi",
            f"cast(inside * (least(high_cell, {GRID}) - greatest(low_cell, 0)) / {GRID} as bigint) as expected",
        )
    )


def _narrowed(
    values: DataFrame, keys: list[str], spans: DataFrame, max_rows: int, sketch: str, slack: float
) -> DataFrame:
    """Wide brackets narrowed by a sketch of the rows inside; a bracket that turns out to miss stays."""
    wide = spans.filter(_wide(max_rows))
    counted = (
        values.join(wide.select(*keys, "lo", "hi"), keys).filter("_x <= hi").groupBy(*keys)
        .agg(
            F.expr("count_if(_x < lo)").alias("below"), F.expr("count_if(_x >= lo)").alias("within"),
            F.expr(sketch.replace("if(isnan(_x),", "if(isnan(_x) or _x < lo,")).alias("finer"),
        )
    )
    covers = "below <= floor(target) and below + within >= least(floor(target) + 2, n) and within < inside"
    joined = pin(wide.join(counted, keys).filter(covers))
    finer = joined.selectExpr(
        *keys, "n", "target", "finer as sketch", "below as before", "within as inside", "lo as old_lo", "hi as old_hi"
    )
    fresh = _bracketed(finer, keys, slack, "double('-infinity')", "double('NaN')").join(
        finer.select(*keys, "old_lo", "old_hi"), keys
    ).withColumns({"lo": F.greatest("lo", "old_lo"), "hi": F.least("hi", "old_hi")}).drop("old_lo", "old_hi")
    rest = spans.join(finer.select(*keys), keys, "left_anti")
    return pin(rest.unionByName(fresh))


def _settled(values: DataFrame, keys: list[str], spans: DataFrame) -> DataFrame:
    """The two order statistics around each target, and whether the bracket held them."""
    # A null stands for all rows below the bracket: they are counted in the same pass and come first.
    counts = (
        values.join(spans.select(*keys, "lo", "hi"), keys).filter("_x <= hi")
        .selectExpr(*keys, "if(_x < lo, null, _x) as _x").groupBy(*keys, "_x").agg(F.count("*").alias("c"))
    )
    running = (
        Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_x"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = counts.withColumn("upto", F.sum("c").over(running)).join(
        spans.selectExpr(*keys, "n", "floor(target) as t0", "target - floor(target) as frac"), keys
    )
    return placed.groupBy(*keys).agg(
        F.expr("min(if(upto > t0, _x, null))").alias("a"),
        F.expr("min(if(upto > t0 + 1, _x, null))").alias("b"),
        F.first("frac").alias("frac"),
        F.expr("coalesce(max(if(_x is null, upto, null)), 0) <= max(t0) and max(upto) >= max(least(t0 + 2, n))").alias("hit"),
    )
