"""Filters of bounded size that stay in the JVM: a table of bitmaps, small enough to be sent to all tasks.

Keys are hashed to bits.  A row whose bit is not set is certainly not among the keys; a few others pass, so the
exact join comes after.  A scan of wide rows thus drops nearly all it does not need without a shuffle and
without Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a bitmap, fixed by ``bitmap_construct_agg``; and bits of all bitmaps, that is 32 KB to 16 MB.
_BITS, LEAST, MOST = 32768, 1 << 18, 1 << 27


class Bitmap:
    """The hashed keys of a table: about 16 bits a key, up to ``MOST`` bits in all."""

    def __init__(self, keys: DataFrame, *columns: str, seed: int = 0) -> None:
        """``keys`` is read twice, so it should be a stored table."""
        self.seed = seed
        self.bits = min(max(1 << max(16 * keys.count() - 1, 1).bit_length(), LEAST), MOST)
        slot = self._slot(*columns)
        spread = keys.select(slot.alias("_slot"))
        self.table = spread.groupBy(F.expr(f"_slot div {_BITS}").alias("_bucket")).agg(
            F.bitmap_construct_agg(F.col("_slot") % _BITS).alias("_bitmap")
        )

    def _slot(self, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns, F.lit(self.seed)), F.lit(self.bits))

    def marked(self, df: DataFrame, name: str, *columns: str) -> DataFrame:
        """``df`` with a boolean column: false where the columns are certainly no key."""
        own = "_"
        while any(c.startswith(own) for c in df.columns):  # names that the rows do not have
            own += "_"
        bucket, bit, byte, bitmap = (own + n for n in ("bucket", "bit", "byte", "bitmap"))
        slot = self._slot(*columns)
        rows = df.select("*", F.floor(slot / _BITS).alias(bucket), (slot % _BITS).cast("int").alias(bit))
        # At most MOST bits, 4 KB a row: bounded whatever the tables.
        held = self.table.select(F.col("_bucket").alias(bucket), F.col("_bitmap").alias(bitmap))
        rows = rows.join(F.broadcast(held), bucket, "left")
        value = F.conv(F.hex(F.substring(bitmap, F.expr(f"{bit} div 8 + 1"), F.lit(1))), 16, 10).cast("int")
        is_set = F.expr(f"shiftright({byte}, {bit} % 8) & 1") == 1
        return rows.withColumn(byte, value).select(*df.columns, F.coalesce(is_set, F.lit(False)).alias(name))
