"""Leave out rows whose key isn't wanted before they move, however many keys there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolcat.scratch import written

#: Bits of the filter, 16 MiB in all; more keys than bits make it let more through, nothing else.
BITS = 1 << 27


def prefilter(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose ``columns`` may be in ``keys``: all that are, and few others. Hashes of the keys set bits of at
    most ``BITS``, which are broadcast in pieces of 4 KiB, so that wide rows are dropped where they are read. Rows with
    a null key go. An exact join comes after it."""
    number = F.pmod(F.xxhash64(*columns), F.lit(BITS))
    piece, bit = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    some = keys.select(*columns).dropna().select(piece.alias("_piece"), bit.alias("_bit"))
    some = some.groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    found = rows.dropna(subset=columns).withColumns({"_piece": piece, "_bit": bit}).join(F.broadcast(written(some, "bits")), "_piece")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return found.filter(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*rows.columns)
