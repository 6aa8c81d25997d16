"""Packing of tokenized documents into sequences: linear grouping, few-size configurations, best fit.

A document is its token ids and the end id. One longer than a sequence is cut from its end into full pieces; what is left
in front is its first piece. Only lengths matter for packing, and there are at most ``capacity`` of them, so the plan is
made from their counts, whatever the number of documents:

1. Pieces of full length stay alone. Large ones (over 1/2, 1/4 or 1/8 of a sequence, whichever gives the best plan) in
   order of length are cut into groups of equal cardinality, and each length counts as the largest of its group.
2. For these few sizes a linear program chooses how often to use which configuration (sizes that fit into a sequence).
   Configurations are generated by a knapsack over the simplex multipliers, until the bound shows that they are
   within half a sequence, or one in 10,000, of the optimum. Numbers of uses are rounded down.
3. Actual pieces take the places of their group, in order. Sequences with the same actual lengths form runs, whose number
   depends on capacity and groups, not on the number of pieces.
4. What is left, large first, then the small pieces, goes by decreasing length where it leaves least space (best fit),
   and to new sequences when none has room. Equal lengths are placed by counting.

The plan is a list of places: so many pieces of one length, from this rank on, into sequences from this number on. A piece
finds its place by its rank in the order of (length, row, piece), which comes from one range sort of narrow rows.

Null and empty texts are the end id alone. Repeated rows and null ids are documents like any other; equal lengths are ranked
by row, so any order of them gives the same number of sequences. Empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from martloom.operators.keys import with_surrogate_key
from martloom.session import stage

CAPACITY = 1024
END_ID = 2
GROUPS = 128
# Pieces over 1/n of a sequence are large, for each n in turn; the plan of fewest sequences is taken.
LARGE = (2, 4, 8)
# Column generation ends when the program's bound proves it to be this near to the optimum.
GAP = 1e-4
# Fixed value: how byte-level tokenizers of this kind cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = "_row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def default_tokenizer() -> str:
    """The tokenizer's file as text."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def encoder(definition: str):
    """text -> ids as the byte-level BPE tokenizer of this definition gives them.

    Its merges are run by another library, some five times faster, whose ranks are the same ids. Texts that hold a special
    token's characters go to the tokenizer itself."""
    parts = json.loads(definition)
    special = [t["content"] for t in parts.get("added_tokens", ())]
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in token): i for token, i in parts["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain: list[Tokenizer] = []

    def ids(text: str) -> np.ndarray:
        if any(s in text for s in special):
            if not plain:
                plain.append(Tokenizer.from_str(definition))
            return np.array(plain[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    return ids


def _cut(definition, capacity: int, with_ids: bool):
    schema = [("_row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema([*schema, ("ids", pa.list_(pa.int32()))] if with_ids else schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for row, doc, text in zip(*(part.column(c).to_pylist() for c in ("_row", "doc_id", "text"))):
                    ids = np.append(encode(text or ""), np.array([END_ID], dtype="<u4"))
                    first = (len(ids) - 1) % capacity + 1
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        piece = ids[a:b].tobytes()
                        out.append((row, doc, n, a, b - a, zlib.crc32(piece), *([ids[a:b].astype(np.int32)] if with_ids else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return cut


def cut_documents(docs: DataFrame, definition: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document: _row, doc_id, piece, start, length, ids_crc32 and, if wanted, the ids."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    return rows.mapInArrow(_cut(shared, capacity, with_ids), PIECE + (", ids array<int>" if with_ids else ""))


class Place(NamedTuple):
    """Pieces of ranks first .. first + pieces - 1 go, ``each`` to a sequence, to sequences from ``sequence`` on."""

    first: int
    pieces: int
    sequence: int
    each: int
    offset: int
    length: int


def _dearest(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is used in the configuration of greatest price (an unbounded knapsack)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i in np.nonzero(prices)[0].tolist():
        size, price = int(sizes[i]), prices[i]
        for c in range(size, capacity + 1, size):  # another copy each time
            end = min(c + size, capacity + 1)
            worth = best[c - size : end - size] + price
            better = worth > best[c:end] + 1e-12
            np.copyto(best[c:end], worth, where=better)
            choice[c:end][better] = i
    uses, c = np.zeros(len(sizes)), capacity
    while choice[c] >= 0:
        uses[choice[c]] += 1
        c -= sizes[choice[c]]
    return uses


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination with row exchange. The library's routine starts threads of its own, which stalled in the driver."""
    m = len(matrix)
    work = np.hstack([matrix, np.eye(m)])
    for i in range(m):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        factors = work[:, i].copy()
        factors[i] = 0
        work -= factors[:, None] * work[i]
    return work[:, m:]


def configurations(sizes: list[int], counts: list[int], capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, float]]:
    """(uses of each size, how often) of a fractional packing within ``gap`` (or half a sequence) of the least number of sequences.

    ``sizes`` ascend. Simplex on the cutting-stock program; the basis starts with one size per configuration."""
    size, m = np.array(sizes), len(sizes)
    need = np.array(counts, dtype=float) + 1e-5 * np.arange(1, m + 1) / m  # no ties between leaving columns, so no cycling
    columns = [np.where(np.arange(m) == i, capacity // size[i], 0).astype(float) for i in range(m)]
    cost = np.ones(m)
    inverse = np.diag(1.0 / np.array([columns[i][i] for i in range(m)]))
    amount = inverse @ need
    for turn in range(1, 20 * m + 1):  # every basis is a packing, so an early end costs sequences, never a piece
        prices = cost @ inverse
        if prices.min() < -1e-9:  # a size covered more often than needed pays
            entering, pays = -(np.arange(m) == prices.argmin()).astype(float), 0.0
        else:
            entering, pays = _dearest(size, np.maximum(prices, 0), capacity), 1.0
            worth = entering @ prices
            if worth <= 1 + 1e-9 or cost @ amount - prices @ need / worth <= max(gap * (cost @ amount), 0.5):
                break
        change = inverse @ entering
        limits = np.where(change > 1e-9, amount / np.where(change > 1e-9, change, 1), np.inf)
        leaving = int(limits.argmin())
        columns[leaving], cost[leaving] = entering, pays
        if turn % 100:
            row = inverse[leaving] / change[leaving]
            inverse -= np.outer(change, row)
            inverse[leaving] = row
        else:  # rounding errors don't build up
            inverse = _inverse(np.array(columns).T)
        amount = np.maximum(inverse @ need, 0)
    return [(columns[i], float(amount[i])) for i in range(m) if cost[i]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: tuple[int, ...] = LARGE) -> tuple[list[Place], int]:
    """The places of all pieces, by first rank, and the number of sequences, from the count of each length."""
    return min((_plan(histogram, capacity, groups, n) for n in large), key=lambda p: p[1])


def _plan(histogram: dict[int, int], capacity: int, groups: int, large: int) -> tuple[list[Place], int]:
    lengths = sorted(length for length, n in histogram.items() if n)
    edges = [0]
    for length in lengths:
        edges.append(edges[-1] + histogram[length])
    at = dict(zip(lengths, edges))
    places: list[Place] = []
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by free space: (first sequence, sequences)
    sequences = 0

    def length_at(rank: int) -> int:
        return lengths[bisect_right(edges, rank) - 1]

    full = histogram.get(capacity, 0)
    if full:
        places.append(Place(at[capacity], full, 0, 1, 0, capacity))
        sequences = full

    low = next((at[n] for n in lengths if n * large > capacity), edges[-1])
    high = edges[-1] - full
    bounds = sorted({low + (high - low) * g // groups for g in range(groups + 1)})
    ends: dict[int, int] = {}  # size -> end of its group; groups of one size are one
    for end in bounds[1:]:
        ends[length_at(end - 1)] = end
    sizes, stops = list(ends), list(ends.values())
    used = [low, *stops[:-1]] if stops else []  # first rank of each group that has no place yet
    counts = [b - a for a, b in zip(used, stops)]
    chosen = configurations(sizes, counts, capacity) if sizes else []
    for uses, often in sorted(chosen, key=lambda c: tuple(c[0]), reverse=True):
        times = int(often + 1e-6)
        if not times:
            continue
        slots, marks = [], {0, times}
        for g in np.nonzero(uses)[0][::-1].tolist():
            for _ in range(int(uses[g])):
                first, last = used[g], min(used[g] + times, stops[g])
                used[g] = last
                slots.append((first, last))
                marks.update(e - first for e in edges if first < e < last)
                marks.add(last - first)
        marks = sorted(marks)
        for a, b in zip(marks, marks[1:]):
            offset = 0
            for first, last in slots:
                if first + a < last:
                    length = length_at(first + a)
                    places.append(Place(first + a, b - a, sequences + a, 1, offset, length))
                    offset += length
            room[capacity - offset].append((sequences + a, b - a))
        sequences += times

    rest: list[tuple[int, int, int]] = []  # (length, first rank, pieces)
    for a, b in [(0, low), *zip(used, stops)]:
        while a < b:
            end = min(edges[bisect_right(edges, a)], b)
            rest.append((length_at(a), a, end - a))
            a = end
    for length, first, n in sorted(rest, key=lambda r: (-r[0], r[1])):
        free = length
        while n:
            if free > capacity:  # no sequence has room
                each = capacity // length
                room[capacity].append((sequences, -(-n // each)))
                sequences += -(-n // each)
                free = capacity
            if not room[free]:
                free += 1
                continue
            start, bins = room[free].pop()
            each = free // length
            take = min(bins, n // each)
            if take:
                places.append(Place(first, take * each, start, each, capacity - free, length))
                room[free - each * length].append((start, take))
                first, n = first + take * each, n - take * each
            elif n:
                take = 1
                places.append(Place(first, n, start, n, capacity - free, length))
                room[free - n * length].append((start, 1))
                first, n = first + n, 0
            if bins > take:
                room[free].append((start + take, bins - take))
    return sorted(places), sequences


def _placed(shared, names: list[str]):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, _, sequence, each, offset, length = shared.value
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            i = np.searchsorted(first, rank, side="right") - 1
            turn = rank - first[i]
            where = [pa.array(sequence[i] + turn // each[i]), pa.array(offset[i] + turn % each[i] * length[i])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *where], [*names, "sequence_id", "offset"])

    return placed


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (of ``cut_documents``) with sequence_id and offset. The counts of at most ``capacity`` lengths come to
    the driver, and the plan goes back to the tasks; both are bounded whatever the number of pieces."""
    names = pieces.columns
    ranked = with_surrogate_key(pieces, ["length", "_row", "piece"], "_rank", start=0)
    histogram = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    places, _ = plan(histogram, capacity, groups)
    arrays = tuple(np.array(c, dtype=np.int64) for c in zip(*places)) if places else (np.zeros(0, np.int64),) * 6
    shared = pieces.sparkSession.sparkContext.broadcast(arrays)
    fields = [*(ranked.schema[c] for c in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return ranked.mapInArrow(_placed(shared, names), T.StructType(fields))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the token ids of every sequence, from packed pieces that hold their ids. A group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))


def packing_report(docs: DataFrame, definition: str) -> DataFrame:
    """One row per piece with its place."""
    pieces = stage(cut_documents(docs, definition), "packing-pieces")
    return pack(pieces).drop("_row")
