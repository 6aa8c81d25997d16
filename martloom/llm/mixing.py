"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source's documents form a token stream in seeded order, cut into blocks of nearly equal size.
Blocks are seats, targets are votes: a source's k-th block is granted while its quotient
``target / (2k - 1)`` is at least half a block, which is the highest-quotient rule with the block as
divisor. Shard j of J takes the seats granted while the threshold falls to J / (j + 1) of that, so
quotas per shard are whole numbers and their running sums stay within half a block of the target.
Each shard takes as many blocks as its quota says, the next ones in a seeded order of the source's blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import WORD, word_count
from martloom.operators.keys import with_surrogate_key
from martloom.session import stage

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 64
MOST_REPEATS = 3
SEED = 11
# A source's stream is ordered bucket by bucket, so no sort group holds a whole source.
BUCKETS = 4096

SHARDS = 8
STRIDES = (1_000_003, 999_983, 999_979)  # primes

ADDED = ["size", "source_size", "target", "taken", "shard_words"]
_INNER = ["_order", "_bucket", "_key", "_before", "_within", "_first", "_lo", "_passes", "_extra", "_parts", "_ends", "_stride", "_blocks", "_seats"]


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``size`` (words), ``_order`` (seeded place in the source's stream), ``_bucket``.

    The order depends on the document's id and size only, not on how the table is stored."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), word_count(F.col("text")).cast("string"))
    return (
        docs.drop(*ADDED, *_INNER)
        .withColumn("size", word_count(F.col("text")))
        .withColumn("_order", F.md5(key.cast("binary")))
        .withColumn("_bucket", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int") % F.lit(BUCKETS))
    )


@dataclass(frozen=True)
class Targets:
    """Sources with size, weight and target, as a staged table."""

    table: DataFrame
    level: float


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> Targets:
    """Targets per source from (source, size) rows.

    All words are shared by weight; a target stops at ``most`` times its source's size and the
    excess goes to the others by weight. The level (words per unit of weight) rises until no
    further source reaches its stop: each round is one aggregate over the staged source table, so
    the number of sources may be large. Sources are weighed in code point order, null last.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = with_surrogate_key(totals.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_place", start=0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    table = stage(numbered.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("stop")), "mix-sources")
    all_words, all_weight = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level, stopped = (all_words / all_weight if all_weight else 0.0), -1
    while True:
        at = F.col("stop") < F.lit(level) * F.col("weight")
        n, words, weight_left = table.agg(
            F.count(F.when(at, 1)), F.coalesce(F.sum(F.when(at, F.col("stop"))), F.lit(0)), F.coalesce(F.sum(F.when(~at, F.col("weight"))), F.lit(0))
        ).first()
        if n == stopped or not weight_left:
            break
        stopped, level = n, (all_words - words) / weight_left
    target = F.least(F.col("stop").cast("double"), F.lit(level) * F.col("weight"))
    return Targets(table.select("source", "source_size", "weight", target.alias("target")), level)


def _seats(block_words: int) -> tuple[Column, Column, Column]:
    """Blocks of a source's stream, the unrounded and the granted number of seats."""
    blocks = F.ceil(F.col("source_size") / F.lit(block_words))
    share = F.when(F.col("source_size") > 0, F.col("target") * blocks / F.col("source_size")).otherwise(F.lit(0.0))
    return blocks.cast("bigint"), share, F.floor(share + F.lit(0.5)).cast("bigint")


def shard_quotas(targets: Targets, shards: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """source, shard, blocks: how many blocks each shard of the mix takes from each source."""
    _, share, _ = _seats(block_words)
    granted = lambda j: F.floor(F.col("_share") * j / F.lit(shards) + F.lit(0.5))
    return (
        targets.table.withColumn("_share", share)
        .select("source", "_share", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        .select("source", "shard", (granted(F.col("shard") + 1) - granted(F.col("shard"))).cast("bigint").alias("blocks"))
    )


def _edge(block: Column) -> Column:
    """First word of a block; blocks differ by a word at most, the longer ones evenly spread."""
    longer = F.col("source_size") % F.col("_blocks")
    before = F.call_function("div", block.cast("decimal(19,0)") * longer.cast("decimal(19,0)"), F.col("_blocks").cast("decimal(19,0)"))
    return block * ((F.col("source_size") - longer) / F.col("_blocks")).cast("bigint") + before


def _draw(block: Column) -> Column:
    """Place of a block in its source's seeded order; its d-th repeat comes d * _blocks later."""
    return (block * F.col("_stride") + F.col("_first")) % F.col("_blocks")


def _plan(targets: Targets, key: Column, block_words: int, seed: int, shards: int, scatter: bool) -> DataFrame:
    """Per source: blocks, seats, the places at which each shard's quota ends, and the seeded order of blocks."""
    quotas = shard_quotas(targets, shards, block_words).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("shard", "blocks"))).alias("_quota"))
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda n: F.aggregate(F.slice("_quota", F.lit(1), n), F.lit(0).cast("bigint"), lambda t, q: t + q["blocks"]))
    blocks, _, _ = _seats(block_words)
    place = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), key), 256), 1, 8), 16, 10).cast("bigint")
    # A stride without a common factor gives every block one place; at most two of the primes divide the number.
    strides = [F.when(F.col("_blocks") % F.lit(prime) != 0, F.lit(prime).cast("bigint")) for prime in STRIDES]
    return (
        targets.table.withColumn("_key", key).withColumn("_blocks", F.greatest(blocks, F.lit(1)))
        .join(quotas.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_ends", ends).withColumn("_seats", F.element_at("_ends", -1))
        .withColumn("_passes", F.floor(F.col("_seats") / F.col("_blocks")).cast("bigint"))
        .withColumn("_stride", F.coalesce(*strides) if scatter else F.lit(1).cast("bigint"))
        .withColumn("_first", place % F.col("_blocks"))
        .select("_key", "source_size", "target", "_blocks", "_seats", "_passes", "_ends", "_stride", "_first")
    )


def mix(docs: DataFrame, targets: Targets, block_words: int = BLOCK_WORDS, seed: int = SEED, shards: int = SHARDS, scatter: bool = True) -> DataFrame:
    """``measured`` documents with source_size, target, taken, shard_words (what each shard takes of them),
    and the parts that are taken.

    A source's blocks stand in a seeded order, repeated as often as needed, and each shard takes the next
    blocks of it, as many as its quota. ``scatter``: the order strides through the stream; else it is the
    stream from a seeded block on, so that few documents are cut. ``_passes``: how often the whole document is
    taken; ``_extra``: the parts (words before, words) taken once more. Sources without words take nothing. Documents
    without words lie in the stream with length 0. Repeated rows take what lies at their places.
    """
    key = F.sha2(F.concat(F.col("source").isNull().cast("string"), F.coalesce(F.col("source"), F.lit(""))), 256)
    docs = docs.withColumn("_key", key)
    buckets = docs.groupBy("_key", "_bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("_key", "_bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before"))
    buckets = buckets.join(_plan(targets, key, block_words, seed, shards, scatter), "_key")
    within = Window.partitionBy("_key", "_bucket").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(buckets, ["_key", "_bucket"])
    placed = placed.withColumn("_lo", F.col("_before") + F.col("_within"))

    # The document's blocks by proportion, one more at either end, cut down to the document.
    near = lambda word: F.floor(word * F.col("_blocks") / F.greatest(F.col("source_size"), F.lit(1))).cast("bigint")
    hi = F.col("_lo") + F.col("size")
    span = F.sequence(F.greatest(near(F.col("_lo")) - 1, F.lit(0)), F.least(near(hi) + 1, F.col("_blocks") - 1))

    def part(block: Column) -> Column:
        start, end = F.greatest(_edge(block), F.col("_lo")), F.least(_edge(block + 1), hi)
        return F.struct(_draw(block).alias("draw"), (start - F.col("_lo")).alias("skip"), (end - start).alias("words"))

    parts = F.filter(F.transform(span, part), lambda p: p["words"] > 0)
    rest = F.col("_seats") % F.col("_blocks")
    placed = placed.withColumn("_parts", F.when(F.col("size") > 0, parts).otherwise(F.filter(parts, lambda p: F.lit(False))))
    chosen = F.transform(F.filter("_parts", lambda p: p["draw"] < rest), lambda p: F.struct(p["skip"].alias("skip"), p["words"].alias("words")))
    placed = placed.withColumn("_extra", chosen if scatter else _runs(chosen))
    added = F.aggregate("_extra", F.lit(0).cast("bigint"), lambda n, p: n + p["words"])
    return placed.withColumn("taken", F.col("_passes") * F.col("size") + added).withColumn("shard_words", _by_shard(shards)).drop(*[c for c in _INNER if c not in ("_passes", "_extra")])


def _runs(chosen: Column) -> Column:
    """The chosen blocks of a document put together where they touch: in stream order a source's run is one
    piece or, past the stream's end, two, so a document has at most two parts: the blocks up to the first gap and the others."""
    gap = F.array_position(
        F.transform(chosen, lambda p, i: (i > 0) & (p["skip"] != F.element_at(chosen, F.greatest(i, F.lit(1)))["skip"] + F.element_at(chosen, F.greatest(i, F.lit(1)))["words"])), F.lit(True)
    ).cast("int")
    upto = F.when(gap > 0, gap - 1).otherwise(F.size(chosen))
    whole = lambda ps: F.struct(ps[0]["skip"].alias("skip"), F.aggregate(ps, F.lit(0).cast("bigint"), lambda n, p: n + p["words"]).alias("words"))
    halves = F.array(F.slice(chosen, F.lit(1), upto), F.slice(chosen, upto + 1, F.size(chosen)))
    return F.transform(F.filter(halves, lambda ps: F.size(ps) > 0), whole)


def _by_shard(shards: int) -> Column:
    """Words of the document in each shard: a block's d-th repeat is in the shard whose quota holds its place."""
    turns = F.sequence(F.lit(0).cast("bigint"), F.col("_passes"))

    def taken(p: Column, shard: Column) -> Column:
        low = F.when(shard > 0, F.element_at("_ends", F.greatest(shard, F.lit(1)))).otherwise(F.lit(0))
        here = F.filter(turns, lambda d: (p["draw"] + d * F.col("_blocks") >= low) & (p["draw"] + d * F.col("_blocks") < F.element_at("_ends", shard + 1)))
        return F.size(here) * p["words"]

    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + taken(p, j)))


def mixed_texts(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: a row for every whole pass over a document, and one for each of its further
    parts, cut at word ends and holding the text between its words."""
    whole = F.array_repeat(F.struct(F.lit(0).cast("bigint").alias("skip"), F.col("size").alias("words")), F.col("_passes").cast("int"))
    takes = F.concat(F.when(F.col("size") > 0, whole).otherwise(F.slice(whole, 1, 0)), "_extra")
    rows = mixed.withColumn("_take", F.explode(takes))
    # A part is rebuilt from the pieces "white space, word"; a whole text is kept as it is.
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, (F.col("_take.skip") + 1).cast("int"), F.col("_take.words").cast("int")), "")
    text = F.when(F.col("_take.words") == F.col("size"), F.col("text")).otherwise(cut)
    return rows.withColumn("text", text).select(*columns)
