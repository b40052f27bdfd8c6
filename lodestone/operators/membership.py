"""Membership filter over composite keys: which rows can't be in a key set.

A key's hash sets one bit; the bits of 32,768 neighbouring hashes are one
binary value, built by ``bitmap_construct_agg`` with map-side combine.  The
filter is broadcast, so testing rows moves none of them.  A row whose bit
isn't set has no partner for certain; one whose bit is set may have one, and
goes on to an exact join.  With ``BITS_PER_KEY`` bits a key, at most one row
in sixteen without a partner passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.joins import BROADCAST_CAP_BYTES

BITS_PER_KEY = 16
_BITMAP_BITS = 1 << 15


class KeyFilter:
    """The bits of a key set: ``bitmaps`` has (_bucket, _bits), a row for each 32,768 bits."""

    def __init__(self, bitmaps: DataFrame, bits: int, keys: Sequence[str]):
        self.bitmaps, self.bits, self.keys = bitmaps, bits, list(keys)

    def tagged(self, df: DataFrame, keys: Sequence[str] | None = None, out: str = "_may") -> DataFrame:
        """``df`` with a flag: False if the row's key is in the set for certain not (NULL in a key counts so)."""
        place = _place([F.col(k) for k in keys or self.keys], self.bits)
        spot = F.bitmap_bit_position(place)
        tested = df.withColumns({"_bucket": F.bitmap_bucket_number(place), "_spot": spot}).join(F.broadcast(self.bitmaps), "_bucket", "left")
        byte = F.conv(F.hex(F.substring("_bits", (F.col("_spot") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return tested.select(*df.columns, F.coalesce(F.getbit(byte, F.col("_spot") % 8) == 1, F.lit(False)).alias(out))


def _place(keys: Sequence[Column], bits: int) -> Column:
    known = keys[0].isNotNull()
    for k in keys[1:]:
        known = known & k.isNotNull()
    return F.when(known, F.pmod(F.xxhash64(*keys), F.lit(bits).cast("long")) + 1)


def key_filter(df: DataFrame, keys: Sequence[str], rows: int | None = None, max_bytes: int | None = None) -> KeyFilter | None:
    """The filter over the keys of ``df``; None if its bits would take more than may be broadcast.

    ``rows`` bounds the number of keys (counted if it isn't given); the cap is
    ``lodestone.broadcast.maxBytes`` as for any broadcast of the library.
    """
    conf = df.sparkSession.conf.get("lodestone.broadcast.maxBytes", None)
    cap = max_bytes if max_bytes is not None else int(conf) if conf else BROADCAST_CAP_BYTES
    n = df.count() if rows is None else rows
    bits = max(1, -(-n * BITS_PER_KEY // _BITMAP_BITS)) * _BITMAP_BITS
    if bits // 8 > cap:
        return None
    place = df.select(_place([F.col(k) for k in keys], bits).alias("_place")).where(F.col("_place").isNotNull())
    bitmaps = (place.groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")))
    return KeyFilter(bitmaps, bits, keys)
