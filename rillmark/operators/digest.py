"""Order-independent content digest of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.session import checkpointed


def row_hash(columns: list[str]):
    """SHA-256 of a row: values as strings with U+001F between, a null as empty text."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def content_digest(df: DataFrame, columns: list[str], fan: int = 3) -> DataFrame:
    """(rows, digest): a tree over the sorted row hashes, independent of order and layout. Repeated rows count.

    Leaves hold the row hashes with one prefix of hexadecimal digits, long enough for about 16^``fan`` rows each; a node above is
    the hash of its children's digests in order, ``fan`` digits at a time, up to the root. So no task ever has more than some
    thousands of hashes, however large the table; there are as many levels as digits/``fan``. An empty table has the hash of an empty text.
    """
    h = checkpointed(df.select(row_hash(columns).alias("d")))
    n = h.count()
    depth, room = 0, 16**fan
    while n > room:
        depth, room = depth + fan, room << 4 * fan
    at = h.select(F.substring("d", 1, depth).alias("p"), "d", F.col("d").alias("o"))
    while True:
        at = at.groupBy("p").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "d"))), lambda x: x["d"]), ""), 256).alias("d"))
        if depth == 0:
            break
        depth -= fan
        at = at.select(F.substring("p", 1, depth).alias("p"), "d", F.col("p").alias("o"))
    got = at.select("d") if n else df.sparkSession.range(1).select(F.sha2(F.lit(""), 256).alias("d"))
    return got.select(F.lit(n).cast("long").alias("rows"), F.col("d").alias("digest"))
