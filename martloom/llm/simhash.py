"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they
share at least 5 positional bytes. Postings on single bytes would grow with the square of the corpus,
so a posting is keyed by the bytes at three positions. Of any 5 shared positions, three lie in one half of
the fingerprint; the 4 + 4 triples inside the halves therefore meet every pair. Each met pair's shared
positional bytes are tallied, pairs with fewer than 5 are dropped, and the rest are verified by Hamming
distance. Fingerprints are distinct before indexing, so copies cost nothing.

A posting of a dense group is a set of mutual neighbours whose pairs must not all be written out.
Long postings are cut into blocks; each pair of blocks is verified in one task of bounded size, which
returns a spanning forest of the links it finds: never more rows than fingerprints it read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.components import components
from martloom.session import stage

SHINGLE = 3
MOST_BITS = 3
LEAST_BYTES = 8 - MOST_BITS
SEED = 42
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
# Postings up to this many fingerprints are joined with themselves; longer ones go block by block.
SHORT_POSTING = 16
BLOCK = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the text's word shingles, as a signed number. bytes.split() and
    bytes.lower() know only ASCII, as the definition wants."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = ends[shingle - 1 :].tolist() if len(words) >= shingle else [len(joined)]
    first = [0, *(ends[: count - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 65536):  # bounded memory for very long texts
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at : at + 65536], last[at : at + 65536])], dtype=">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > count).view(">i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of each whole text; 0 for no words or null."""
    return docs.withColumn(name, _fingerprints(F.col(text)))


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 56 - 8 * position).bitwiseAND(F.lit(255))


def _postings(fps: DataFrame) -> DataFrame:
    """(key, fp): the bytes at each triple of positions, with the triple's number in front."""
    keys = []
    for n, (a, b, c) in enumerate(TRIPLES):
        bytes3 = F.shiftleft(_byte(F.col("fp"), a), 16) + F.shiftleft(_byte(F.col("fp"), b), 8) + _byte(F.col("fp"), c)
        keys.append((F.lit(n << 24) + bytes3).cast("int"))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _tally(a: Column, b: Column) -> Column:
    """Number of positional bytes two fingerprints share."""
    return sum((F.when(_byte(a, p) == _byte(b, p), 1).otherwise(0) for p in range(1, 8)), F.when(_byte(a, 0) == _byte(b, 0), 1).otherwise(0))


def _forest(group: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the links between (or inside) the two blocks of a block pair."""
    sides = [group.loc[group["side"] == s, "fp"].to_numpy(dtype=np.int64).view(np.uint64) for s in (0, 1)]
    left, right = sides[0], sides[1] if len(sides[1]) else sides[0]
    nodes = np.unique(np.concatenate([left, right]))
    at_left, at_right = np.searchsorted(nodes, left), np.searchsorted(nodes, right)
    label = np.arange(len(nodes))
    out: list[tuple[int, int]] = []
    for i in range(0, len(left), 256):
        differ = left[i : i + 256, None] ^ right[None, :]
        shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2)
        x, y = np.nonzero((shared >= LEAST_BYTES) & (np.bitwise_count(differ) <= MOST_BITS))
        a, b = at_left[i : i + 256][x], at_right[y]
        while len(a):  # joins whole components; each turn merges every component with a link left
            fresh = label[a] != label[b]
            a, b = a[fresh], b[fresh]
            if not len(a):
                break
            la, lb = label[a], label[b]
            high, low = np.maximum(la, lb), np.minimum(la, lb)
            roots, pick = np.unique(high, return_index=True)  # one link per higher label
            out += zip(nodes[a[pick]].tolist(), nodes[b[pick]].tolist())
            parent = np.arange(len(nodes))
            parent[roots] = low[pick]
            while True:  # parents are lower, so this ends
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            label = parent[label]
    pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def links(fps: DataFrame) -> DataFrame:
    """(a, b) links among distinct fingerprints ``fp``: they connect exactly what is linked at 3 or
    fewer bits. Pairs in short postings all appear; inside long ones a spanning forest does."""
    postings = _postings(fps)
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = stage(postings.join(sizes, "key"), "simhash-postings")

    short = met.where(F.col("n") <= SHORT_POSTING).select("key", "fp")
    a, b = short.alias("a"), short.alias("b")
    tallied = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & (_tally(F.col("a.fp"), F.col("b.fp")) >= LEAST_BYTES))
    short_links = tallied.where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MOST_BITS).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    long = (
        met.where(F.col("n") > SHORT_POSTING).withColumns({"blocks": blocks, "own": own}).withColumn("other", other)
        .select("key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    )
    long_links = long.groupBy("key", "i", "j").applyInPandas(_forest, "a long, b long")
    return short_links.union(long_links).distinct()


def near_duplicates(docs: DataFrame, further: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """doc_id, fp, component_id: the smallest id reachable over links, itself included.

    ``further`` adds links (a, b) between fingerprints; it is given ``docs`` with their fingerprints, read again.

    One row per input row. Null texts and texts without words have fingerprint 0, linked like any
    other. Null ids are never the smallest; a component of null ids alone has a null one. Only
    doc_id and text are read.
    """
    if further is None:
        marked = stage(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash-fps")
    else:
        marked = stage(with_fingerprint(docs), "simhash-fps")
    groups = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    linked = links(groups.select("fp"))
    if further is not None:
        linked = linked.union(further(marked))
    joined = components(linked, "a", "b")  # node, root: only linked fingerprints
    in_component = groups.join(joined, groups["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = in_component.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = in_component.where(F.col("root") != F.col("fp")).select("fp", "root").join(least, "root").select("fp", "component_id")
    roots = in_component.where(F.col("root") == F.col("fp")).select("fp").join(least, F.col("fp") == F.col("root")).select("fp", "component_id")
    return marked.join(stage(ids.union(roots), "simhash-components"), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
