"""One row a key without moving rows that are the only ones of theirs.

``dropDuplicates`` on a table of texts shuffles every text, though few keys come twice. Here
the keys that do are found from the key column alone and put into a bit table of fixed size;
rows whose bit is unset are let through where they are, and only the others are shuffled and
compared. A bit that two keys share costs a needless comparison, never a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Bits of the table; at most ``2 ** (BITS - 6)`` rows of a word each are broadcast.
BITS = 24


def one_per_key(df: DataFrame, *keys: str, bits: int = BITS) -> DataFrame:
    """An arbitrary row of each key, as ``dropDuplicates(keys)`` gives; nulls in a key are equal.

    Rows of a key must be equal where it matters, or be filtered so before.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(place.alias("_place"))
    words = again.groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_place % 64 as int))")).alias("_bits"))
    marked = df.withColumn("_place", place).withColumn("_word", F.shiftright("_place", 6)).join(F.broadcast(words), "_word", "left")
    doubtful = F.coalesce(F.expr("shiftright(_bits, cast(_place % 64 as int)) & 1L"), F.lit(0)) == 1
    alone = marked.filter(~doubtful).select(*df.columns)
    return alone.unionByName(marked.filter(doubtful).select(*df.columns).dropDuplicates(list(keys)))
