"""Content stamps that identify the version of a table a result was computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


#: The stamp is a number below this, the Mersenne prime 2**61 - 1.
MODULUS = 2305843009213693951


#: Powers of two below which a double's size is for each of the powers by which it is scaled down.
SCALES = {0: 2.0**42, 42: 2.0**84, 84: 2.0**126}
LAST_SCALE = 982


def _case(x: str, values: dict[int, str]) -> str:
    """SQL of the value that goes with the scale of ``x``."""
    cases = " ".join(f"when {x} < {below!r} then {values[scale]}" for scale, below in SCALES.items())
    return f"case {cases} else {values[LAST_SCALE]} end"


def canonical_rows(df: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and ``_r``, a text of the other columns in which equal values always read the same.

    A double reads as its value in units of 2**-20 and, of the rest, in units of 2**-60.  Scaling by powers
    of two is exact, so only differences under 2**-60 are lost.  A value of 2**42 or more is first scaled
    down by 2**42, by 2**84, or by 2**982, which keeps its leading 53 bits in all but the last range.  NaN and
    the infinities have their own texts.  Each step is a projection of its own, so that no part is
    computed, or compiled, once for each of its uses.
    """
    fields = [f for f in df.schema if f.name not in keys]
    doubles = [i for i, f in enumerate(fields) if isinstance(f.dataType, (DoubleType, FloatType))]
    scales = (*SCALES, LAST_SCALE)
    rows = df.selectExpr(*keys, *(
        f"cast({f.name} as double) as _x{i}" if i in doubles else f"cast({f.name} as string) as _t{i}"
        for i, f in enumerate(fields)
    ))
    factors = {scale: f"{2.0**-scale!r}D" for scale in scales}
    rows = rows.selectExpr("*", *(f"_x{i} * {_case(f'abs(_x{i})', factors)} as _v{i}" for i in doubles))
    rows = rows.selectExpr("*", *(f"cast(floor(_v{i} * 1048576e0) as bigint) as _w{i}" for i in doubles))
    labels = {scale: f"'{scale}:'" for scale in scales}
    texts = (
        f"case when isnan(_x{i}) then 'nan' when _x{i} > 1.7976931348623157e308 then 'inf'"
        f" when _x{i} < -1.7976931348623157e308 then '-inf' else concat({_case(f'abs(_x{i})', labels)}, cast(_w{i} as string),"
        f" '/', cast(cast(floor((_v{i} * 1048576e0 - _w{i}) * 1099511627776e0) as bigint) as string)) end as _t{i}"
        for i in doubles
    )
    rows = rows.selectExpr(*keys, *(f"_t{i}" for i in range(len(fields)) if i not in doubles), *texts)
    return rows.selectExpr(*keys, "concat_ws('|', {}) as _r".format(", ".join(f"coalesce(_t{i}, '~')" for i in range(len(fields)))))


def stamp_parts(df: DataFrame, *keys: str) -> DataFrame:
    """Row count and sum of row hashes per ``keys``: parts that add up to the stamp of the whole.

    ``keys`` are not part of the rows that are hashed.
    """
    return (
        canonical_rows(df, *keys)
        .selectExpr(*keys, "cast(conv(substr(md5(_r), 1, 15), 16, 10) as bigint) as _h")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_rows"),
            F.expr("cast(coalesce(sum(cast(_h as decimal(20, 0))), 0) as decimal(38, 0))").alias("hash_sum"),
        )
    )


def merged_stamp(parts: DataFrame) -> DataFrame:
    """The stamp of a table from its parts, in one row."""
    return parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.sum("hash_sum").alias("_sum")).selectExpr(
        "n_rows", f"cast((coalesce(_sum, 0) % {MODULUS} * 31 + n_rows) % {MODULUS} as bigint) as stamp"
    )


def content_stamp(df: DataFrame) -> DataFrame:
    """Row count and order-independent hash of the whole content, in one row.

    The hash is the sum of the rows' hashes, in which equal rows add up, with the row count.
    """
    return merged_stamp(stamp_parts(df))


def stamp_value(df: DataFrame | None) -> int:
    """The stamp as a number, -1 where there is no table."""
    return -1 if df is None else content_stamp(df).first()["stamp"]
