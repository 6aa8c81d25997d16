"""Shards by a Feistel permutation over global row numbers.

Rows are numbered 0..n-1 in a fixed order by one range sort. A keyed permutation of these numbers
shuffles them; permuted number p goes to shard ``p % shards``, slot ``p // shards``. Shards differ
by at most one row, slots are gapless, and anyone who knows (row number, n, seed) can compute both.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.keys import with_surrogate_key

ROUNDS = 6
WALKS = 16  # unrolled cycle walks, see permuted()
_PRIME = (1 << 31) - 1


def domain(rows: int) -> tuple[int, int]:
    """The smallest near-square grid (a, b) with a * b >= rows; less than a cells are spare."""
    a = max(1, isqrt(rows - 1) + 1) if rows else 1
    return a, max(1, -(-rows // a))


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    keys = []
    for i in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        keys.append(tuple(1 + int.from_bytes(digest[4 * j : 4 * j + 4], "big") % (_PRIME - 1) for j in range(3)))
    return keys


def _feistel(p: Column, rows: int, seed: int) -> Column:
    """One application of the permutation of the whole grid. Halves are numbers mod a and mod b,
    each round adds a keyed mix of one half to the other, which can always be undone."""
    a, b = domain(rows)
    keys = F.array(*[F.struct(F.lit(i % 2 == 0).alias("left"), *[F.lit(v).cast("bigint").alias(c) for c, v in zip("xyz", k)]) for i, k in enumerate(round_keys(seed))])

    def mix(v: Column, k: Column) -> Column:
        s = (v + k["x"]) % F.lit(_PRIME)
        return ((s * s) % F.lit(_PRIME) * k["y"] + k["z"]) % F.lit(_PRIME)

    def step(h: Column, k: Column) -> Column:
        l, r = h["l"], h["r"]
        return F.struct(
            F.when(k["left"], (l + mix(r, k)) % F.lit(a)).otherwise(l).alias("l"),
            F.when(k["left"], r).otherwise((r + mix(l, k)) % F.lit(b)).alias("r"),
        )

    # floor(p / b) in whole numbers: a double could not hold large row numbers
    start = F.struct(((p - p % F.lit(b)) / F.lit(b)).cast("bigint").alias("l"), (p % F.lit(b)).alias("r"))
    return F.aggregate(keys, start, step, lambda h: h["l"] * F.lit(b) + h["r"])


def permuted(row: Column, rows: int, seed: int) -> Column:
    """The permuted number of a row number, by cycle walking: results outside 0..rows-1 are
    permuted again. A walk can leave the range at most ``a * b - rows`` times in a row; up to
    ``WALKS`` repeats are written out. For larger tables each repeat has a chance of less than
    1 / sqrt(rows), so running out is beyond all odds; should it happen, the job fails loudly.
    """
    a, b = domain(rows)
    row = row.cast("bigint")
    p = _feistel(row, rows, seed)
    repeats = min(a * b - rows, WALKS)
    if repeats <= 0:
        return p
    p = F.aggregate(F.sequence(F.lit(1), F.lit(repeats)), p, lambda q, _: F.when(q < rows, q).otherwise(_feistel(q, rows, seed)))
    return F.when(p < rows, p).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("bigint"))


def shard_and_slot(row: Column, rows: int, shards: int, seed: int) -> tuple[Column, Column]:
    p = permuted(row, rows, seed)
    return (p % F.lit(shards)).cast("int"), ((p - p % F.lit(shards)) / F.lit(shards)).cast("bigint")


def shard_rows(df: DataFrame, order: list[str], shards: int = 24, seed: int = 7) -> DataFrame:
    """``df`` with ``row_number`` (from 0, in the order of ``order``, nulls first), ``shard``, ``slot``.

    Columns of ``df`` with these names are replaced. Rows equal in ``order`` are numbered in
    reading order, which keeps a hot value from landing in one range partition; list enough columns
    that such rows are equal in all that matters. An empty table gives an empty result. One range
    sort and one write of ``df``'s columns, so pass narrow rows.
    """
    df = df.drop("row_number", "shard", "slot").withColumn("_tie", F.monotonically_increasing_id())
    numbered = with_surrogate_key(df, [*order, "_tie"], "row_number", start=0)
    rows = numbered.count()
    shard, slot = shard_and_slot(F.col("row_number"), max(rows, 1), shards, seed)
    return numbered.withColumns({"shard": shard, "slot": slot}).drop("_tie")


def text_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, a null one has none, plus 8), text_crc32 (null for a
    null text)."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """Every document's size, checksum, shard and slot. Row numbers follow (doc_id, checksum, size),
    so the result does not depend on how the table is stored. Null ids come first; repeated rows
    are rows of their own; other columns are ignored."""
    return shard_rows(text_sizes(docs), ["doc_id", "text_crc32", "size"], shards, seed)
