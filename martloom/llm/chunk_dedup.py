"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

A cut falls where bits of the rolling hash are zero; these bits depend on the last 16 bytes alone, so an
insertion moves cuts only near itself. Each chunk has a 128-bit digest. Digests found in two or more
documents mark their chunks, and neighbouring marked chunks form a repeat; short repeats are
coincidence and dropped, but for copies of whole texts. The first holder of a chunk (in the table's order) keeps it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martloom.session import stage

SEED = 17
CUT_BITS = 5  # a cut every 32 bytes or so
WINDOW_BITS = 16  # hash bits in use; bit k depends on the last k + 1 bytes
LEAST_BYTES = 16
MOST_BYTES = 96
# A passage of over 50 words loses the two chunks at its ends and what leads up to the first common cut; some
# lose more and are missed (README).
LEAST_WORDS = 25

_GEAR = np.random.default_rng(SEED).integers(0, 1 << WINDOW_BITS, size=256, dtype=np.uint16)
_MASK = np.uint16(((1 << CUT_BITS) - 1) << (WINDOW_BITS - CUT_BITS))


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``, the last one its length."""
    n = len(data)
    if not n:
        return []
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    width = 1
    while width < WINDOW_BITS:  # the hash of the last 2w bytes from two of w
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
        width *= 2
    possible = (np.nonzero((h & _MASK) == 0)[0] + 1).tolist()
    out, start = [], 0
    for p in [*possible, n]:
        while p - start > MOST_BYTES:
            start += MOST_BYTES
            out.append(start)
        if p - start >= LEAST_BYTES or (p == n and p > start):
            out.append(p)
            start = p
    return out


def chunks_of(data: bytes) -> tuple[np.ndarray, bytes]:
    """Place and digest (16 bytes each) of every chunk. A place holds, from its low bits on: whether the digest
    came before in this text (1 bit), words that begin in the chunk (6), its bytes (7), its first byte."""
    ends = cuts(data)
    if not ends:
        return np.empty(0, dtype=np.int64), b""
    codes = np.frombuffer(data, dtype=np.uint8)
    ink = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    begins = np.cumsum(ink & np.concatenate([[True], ~ink[:-1]]), dtype=np.int64)
    end = np.array(ends, dtype=np.int64)
    start, words = np.concatenate([[0], end[:-1]]), np.diff(begins[end - 1], prepend=0)
    digests = [xxhash.xxh3_128_digest(data[i:j]) for i, j in zip(start.tolist(), ends)]
    seen: set[bytes] = set()
    again = np.array([d in seen or seen.add(d) is not None for d in digests])
    return start << 14 | (end - start) << 7 | words << 1 | again, b"".join(digests)


_CHUNKS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("at", "hi", "lo")]))


@F.arrow_udf(_CHUNKS)
def _chunks(texts: pa.Array) -> pa.Array:
    # Flat arrays, one text at a time: a batch never exists as Python objects for each chunk.
    places, digests, ends = [], [], [0]
    for text in texts:
        data = text.as_buffer()
        at, own = chunks_of(data.to_pybytes() if data else b"")
        places.append(at)
        digests.append(own)
        ends.append(ends[-1] + len(at))
    pairs = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
    columns = [np.concatenate([*places, np.empty(0, dtype=np.int64)]), pairs[:, 0], pairs[:, 1]]
    each = pa.StructArray.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["at", "hi", "lo"])
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), each)


def _start(at: Column) -> Column:
    return F.shiftrightunsigned(at, 14)


def _bytes(at: Column) -> Column:
    return F.shiftrightunsigned(at, 7).bitwiseAND(127)


def _words(at: Column) -> Column:
    return F.shiftrightunsigned(at, 1).bitwiseAND(63)


def _chunked(docs: DataFrame) -> DataFrame:
    """_row, doc_id, c (chunks), size, md5 of the text, staged."""
    row = F.col("_row") if "_row" in docs.columns else F.monotonically_increasing_id()
    text = F.col("text").cast("binary")
    return stage(docs.select(row.alias("_row"), "doc_id", F.octet_length("text").alias("size"), F.md5(text).alias("md5"), _chunks(F.col("text")).alias("c")), "chunks")


def _spans(chunked: DataFrame, least_words: int, apart: bool) -> DataFrame:
    """_row, start, end, words, chunks, later, firsts (rows that keep its chunks)."""
    each = chunked.select("_row", F.explode("c").alias("c")).select("_row", "c.*")
    # Only what the shuffles need goes through them: longs, so that both sums are hash aggregates.
    digests = each.groupBy("hi", "lo").agg(F.min("_row").alias("first"), F.max("_row").alias("last")).where("first != last").drop("last")
    later = (F.col("first") != F.col("_row")) | (F.col("at").bitwiseAND(1) == 1)
    at = F.col("at")
    marked = each.join(digests, ["hi", "lo"]).select(
        "_row", "first", _start(at).cast("int").alias("start"), (_start(at) + _bytes(at)).cast("int").alias("end"), _words(at).alias("words"), later.cast("int").alias("later")
    )
    kind = ["later"] if apart else []
    order = Window.partitionBy("_row", *kind).orderBy("start")
    begins = (F.coalesce(F.lag("end").over(order), F.lit(-1)) != F.col("start")).cast("int")
    runs = marked.withColumn("run", begins).withColumn("run", F.sum("run").over(order))
    return runs.groupBy("_row", "run", *kind).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count("*").alias("chunks"),
        F.sum("later").alias("_later"), F.collect_set("first").alias("firsts"),
    ).where(F.col("words") >= least_words).select("_row", "start", "end", "words", "chunks", F.col("_later").alias("later"), "firsts")


def _short_copies(chunked: DataFrame, least_words: int) -> DataFrame:
    """Whole texts that other rows hold too, of one word up to what ``_spans`` reports; columns as there."""
    words = F.aggregate("c", F.lit(0).cast("bigint"), lambda n, c: n + _words(c["at"]))
    texts = chunked.select("_row", "size", "md5", words.alias("words"), F.size("c").cast("bigint").alias("chunks")).where((F.col("words") > 0) & (F.col("words") < least_words))
    firsts = texts.groupBy("md5", "size").agg(F.min("_row").alias("first"), F.max("_row").alias("last")).where("first != last")
    later = F.when(F.col("first") == F.col("_row"), F.lit(0)).otherwise(F.col("chunks"))
    return texts.join(firsts, ["md5", "size"]).select("_row", F.lit(0).alias("start"), F.col("size").alias("end"), "words", "chunks", later.alias("later"), F.array("first").alias("firsts"))


def repeats(docs: DataFrame, least_words: int = LEAST_WORDS, apart: bool = False) -> DataFrame:
    """(_row, doc_id, start, end, words, chunks, later, first_ids): spans of whole chunks, in bytes of the
    UTF-8 text, that other rows hold too. ``later``: chunks of it that an earlier row keeps, or an earlier place
    of the row; ``first_ids``: the ids of the rows that keep its chunks, without nulls. Rows are in the order
    of the table, or of ``_row`` if there is one. ``apart``: a span ends where its chunks change from
    those that are kept earlier to those that the row keeps itself, so all of it is kept by one side, and the word bound is on each such span.

    Repeated rows are copies of each other and repeat wholly, at any length of one word or more. Null and empty texts
    have no chunks. Only doc_id, text and ``_row`` are read.
    """
    chunked = _chunked(docs)
    spans = _spans(chunked, least_words, apart).unionByName(_short_copies(chunked, least_words))
    ids = chunked.select("_row", "doc_id")
    spans = spans.join(ids, "_row")
    holders = spans.select("_row", "start", F.explode("firsts").alias("first")).join(ids.select(F.col("_row").alias("first"), F.col("doc_id").alias("id")), "first")
    holders = holders.groupBy("_row", "start").agg(F.array_sort(F.collect_set("id")).alias("first_ids"))
    return spans.join(holders, ["_row", "start"]).select("_row", "doc_id", "start", "end", "words", "chunks", "later", "first_ids")


def repeat_report(docs: DataFrame) -> DataFrame:
    """A row for each repeat: doc_id, its span, sizes, and the ids that keep its text."""
    return repeats(docs.select("doc_id", "text")).select(
        "doc_id", F.col("start").cast("long").alias("start_byte"), F.col("end").cast("long").alias("end_byte"), F.col("words").alias("n_words"),
        F.col("chunks").alias("n_chunks"), F.col("later").alias("n_later"), "first_ids",
    )


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with every part of a repeat that earlier rows keep cut out of ``text``; what the row
    keeps itself stays. Cuts fall back to whole characters."""
    numbered = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "chunk-docs")
    chunked = _chunked(numbered)
    spans = _spans(chunked, least_words, apart=True).unionByName(_short_copies(chunked, least_words)).where("later > 0").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cut"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, spans):
            if gone is None or not len(gone):
                out.append(text)
                continue
            data, at, kept = text.encode("utf-8", "surrogatepass"), 0, []
            for s in gone:
                start, end = s["start"], s["end"]
                while start > at and data[start] & 0xC0 == 0x80:
                    start -= 1
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    end += 1
                kept.append(data[at:start])
                at = max(at, end)
            out.append(b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass"))
        return pd.Series(out)

    return numbered.join(spans, "_row", "left").withColumn("text", cut("text", "_cut")).select(*docs.columns)
