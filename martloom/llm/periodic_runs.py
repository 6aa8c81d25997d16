"""Periodic runs in texts: block convolution at dyadic scales, distances as seeds, extension to both ends.

A run is a stretch of consecutive words with smallest period q, of max(6, 4 q) words or more, that no
neighbouring word extends. The scale of a period q is the power of two B with B <= q < 2 B. A run of period q holds
two neighbouring aligned blocks of B words that both occur again q words later, in the 2 B words that follow each.
So at every scale each aligned block is correlated with its following window: by squared differences of word
numbers, sum (a[i] - w[l + i])^2 = 0 exactly where it occurs. The products are cyclic convolutions by number-theoretic
transform, for all blocks of a batch of texts at once. A sum is below blocks times the largest number squared; as many
primes are taken as make their product larger, so that "zero modulo each prime" is "zero": the test is exact.
A distance found for two neighbouring blocks is a seed: equality at this distance is followed to both
ends, and the stretch is a run if long enough. Scales go upwards, so a stretch is first met with its smallest period.

Texts are independent, so nothing is shuffled; a task's memory is a few times its largest text. Null texts have no words,
texts of fewer than 6 words no runs; repeated rows and null ids are handled like any other row. Other columns aren't touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_WORDS = 6
LEAST_PERIODS = 4
# Primes of the form k 2^26 + 1 or k 2^27 + 1, below 2^31: transforms of up to 2^26 words, so texts of up to 2^27 words.
PRIMES = (469762049, 2013265921, 1811939329)
# Cells of one batch of transforms (they stay in a core's cache) and words of texts taken together.
CELLS = 1 << 15
BATCH_WORDS = 1 << 18
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"

Change = Callable[[int | None, list[bytes]], list[bytes]]


_powers: dict[tuple[int, int, bool], np.ndarray] = {}


def _twiddles(p: int, half: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. half-1 of an element of order 2 * half modulo p, as a column."""
    if (p, half, inverse) not in _powers:
        _powers[p, half, inverse] = _new_twiddles(p, half, inverse)
    return _powers[p, half, inverse]


def _new_twiddles(p: int, half: int, inverse: bool) -> np.ndarray:
    if half == 1:
        return np.ones((1, 1), dtype=np.int64)
    x = 2  # any non-residue gives full order; small numbers are tried
    while pow(x, (p - 1) // 2, p) == 1:
        x += 1
    root = pow(x, (p - 1) // (2 * half), p)
    out = np.ones(half, dtype=np.int64)
    step, done = pow(root, -1 if inverse else 1, p), 1
    while done < half:  # doubling: the next powers are the known ones times one factor
        out[done : 2 * done] = out[:done] * pow(step, done, p) % p
        done *= 2
    return out[:, None]


def _reduce(x: np.ndarray, p: int, spare: np.ndarray) -> None:
    np.floor_divide(x, p, out=spare)
    spare *= p
    x -= spare


def _forward(x: np.ndarray, p: int, spare: np.ndarray, spare2: np.ndarray) -> None:
    """In-place transform of each column of x (values 0 .. p-1), order bit-reversed."""
    n, m = x.shape
    half, bound = n // 2, 1
    while half:
        if bound * p * p >= 1 << 62:
            _reduce(x, p, spare)
            bound = 1
        pairs = x.reshape(-1, 2, half, m)
        u, v = pairs[:, 0], pairs[:, 1]
        gap = spare.reshape(-1)[: x.size // 2].reshape(u.shape)
        quotient = spare2.reshape(-1)[: x.size // 2].reshape(u.shape)
        np.subtract(u, v, out=gap)
        u += v
        if half > 1:
            gap *= _twiddles(p, half, False)
            np.floor_divide(gap, p, out=quotient)
            quotient *= p
            np.subtract(gap, quotient, out=v)
        else:
            v[...] = gap
        half //= 2
        bound *= 2
    _reduce(x, p, spare)


def _backward(x: np.ndarray, p: int, spare: np.ndarray, spare2: np.ndarray) -> None:
    """Inverse of _forward, but for the factor 1/n."""
    n, m = x.shape
    half, bound = 1, 1
    while half < n:
        if (bound + 1) * p * p >= 1 << 62:
            _reduce(x, p, spare)
            bound = 1
        pairs = x.reshape(-1, 2, half, m)
        u, v = pairs[:, 0], pairs[:, 1]
        turned = spare.reshape(-1)[: x.size // 2].reshape(u.shape)
        quotient = spare2.reshape(-1)[: x.size // 2].reshape(u.shape)
        if half > 1:
            np.multiply(v, _twiddles(p, half, True), out=turned)
            np.floor_divide(turned, p, out=quotient)
            quotient *= p
            turned -= quotient
        else:
            turned[...] = v
        np.subtract(u, turned, out=v)
        u += turned
        half *= 2
        bound += 1
    _reduce(x, p, spare)


def occurrences(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(column, lag) of every place where a block occurs in its following window, by column, then lag.

    ``cells`` holds 3 B rows: a block of B word numbers and the 2 B that follow it, in each column.
    """
    size, m = cells.shape[0] // 3, cells.shape[1]
    block, window = cells[:size], cells[size:]
    top = int(cells.max(initial=0))
    spare, spare2 = np.empty((2 * size, m), dtype=np.int64), np.empty((2 * size, m), dtype=np.int64)
    found, covered = None, 1
    for p in PRIMES:
        squares, own = window * window, block * block
        if 2 * size * top * top >= 1 << 62:
            squares, own = squares % p, own % p
        sums = np.cumsum(squares, axis=0)
        total = sums[size - 1 : 2 * size - 1].copy()
        total[1:] -= sums[: size - 1]
        total += own.sum(axis=0)
        turned = np.zeros((2 * size, m), dtype=np.int64)
        turned[0] = block[0]
        turned[size + 1 :] = block[:0:-1]
        other = window.copy()
        if top >= p:
            turned, other = turned % p, other % p
        _forward(turned, p, spare, spare2)
        _forward(other, p, spare, spare2)
        turned *= other
        _reduce(turned, p, spare)
        _backward(turned, p, spare, spare2)
        product = turned[:size] * pow(2 * size, -1, p) % p
        total -= 2 * product
        zero = total % p == 0
        found = zero if found is None else found & zero
        covered *= p
        if covered > size * top * top:
            break
    return np.nonzero(found.T)


def _equal_from(x: np.ndarray, i: int, stop: int, d: int) -> int:
    """First place from i on, below stop, where x differs from x shifted by d; stop if none."""
    step = 64
    while i < stop:
        end = min(i + step, stop)
        differ = x[i:end] != x[i + d : end + d]
        at = int(differ.argmax())
        if differ[at]:
            return i + at
        i, step = end, step * 2
    return stop


def _equal_before(x: np.ndarray, i: int, least: int, d: int) -> int:
    """Smallest place from which on x equals x shifted by d up to i."""
    step = 64
    while i > least:
        first = max(i - step, least)
        differ = (x[first:i] != x[first + d : i + d])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return i - at
        i, step = first, step * 2
    return least


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period; a text is its word numbers 0, 1, ..."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
    # Each text is followed by one cell that equals none of its words; windows past its end read that cell.
    x = np.concatenate([part for i in order for part in (texts[i], [int(texts[i].max(initial=-1)) + 1])]).astype(np.int64) if order else np.zeros(0, np.int64)
    ends = np.cumsum(sizes + 1) - 1
    firsts = ends - sizes
    covered_to, covered_by = np.zeros(len(x), dtype=np.int64), np.ones(len(x), dtype=np.int64)
    runs: dict[tuple[int, int], int] = {}
    size = 1
    while len(sizes) and sizes[-1] >= max(LEAST_WORDS, LEAST_PERIODS * size):
        take = sizes >= max(LEAST_WORDS, LEAST_PERIODS * size)
        blocks = sizes[take] // size - 1
        before = np.cumsum(blocks) - blocks
        starts = np.repeat(firsts[take] - size * before, blocks) + size * np.arange(blocks.sum())
        stops = np.repeat(ends[take], blocks)
        reach, per = np.arange(3 * size)[:, None], max(1, CELLS // (2 * size))
        parts = []
        for at in range(0, len(starts), per):
            column, lag = occurrences(x[np.minimum(starts[None, at : at + per] + reach, stops[None, at : at + per])])
            parts.append((starts[at + column], size + lag))
        s, d = (np.concatenate(a) for a in zip(*parts))
        key = s * (4 * size) + d
        step = size * 4 * size
        near = np.isin(key - step, key, assume_unique=True) | np.isin(key + step, key, assume_unique=True)
        new = near & ~((covered_to[s] >= s + size + d) & (d % covered_by[s] == 0))
        s, d = s[new], d[new]
        by = np.lexsort((s, d))
        last_d = last_end = -1
        for i, q in zip(s[by].tolist(), d[by].tolist()):
            if q == last_d and i < last_end:
                continue  # the stretch found last holds this block too
            if covered_to[i] >= i + size + q and q % covered_by[i] == 0:
                continue
            text = int(np.searchsorted(ends, i))
            start = _equal_before(x, i, int(firsts[text]), q)
            end = _equal_from(x, i + size, int(ends[text]) - q, q)
            last_d, last_end = q, end
            if end + q - start < max(LEAST_WORDS, LEAST_PERIODS * q) or (start, end + q) in runs:
                continue
            runs[start, end + q] = q
            cells = slice(start, end + q)
            longer = covered_to[cells] < end + q
            covered_by[cells][longer] = q
            covered_to[cells][longer] = end + q
        size *= 2
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, end), q in sorted(runs.items(), key=lambda r: (r[0][0], r[1])):
        text = int(np.searchsorted(ends, start))
        out[order[text]].append((int(start - firsts[text]), end - start, q))
    return out


def numbered(words: list[bytes]) -> np.ndarray:
    """Word numbers 0, 1, ... by first use."""
    met: dict[bytes, int] = {}
    return np.fromiter((met.setdefault(w, len(met)) for w in words), dtype=np.int64, count=len(words))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join([w for w, n in zip(words, np.cumsum(drop).tolist()) if not n])


def _searched(change: Change | None):
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.binary())])

    def answers(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        found = find_runs([numbered(w) for _, w in held])
        rows = [[dict(zip(("start", "length", "period"), run)) for run in runs] for runs in found]
        texts = [collapsed(w, runs) for (_, w), runs in zip(held, found)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([i for i, _ in held], rows, texts), schema.types)], schema=schema)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, key in enumerate(batch.column("doc_id").to_pylist()):
                words = (texts[i].as_py() or b"").split()
                held.append((key, change(key, words) if change else words))
                total += len(words)
                if total >= BATCH_WORDS:
                    yield answers(held)
                    held, total = [], 0
        if held:
            yield answers(held)

    return searched


def periodic_runs(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """doc_id, runs (start, length, period in words, by start, then period) and the text without repeated periods.

    ``change`` may replace a text's words, by doc_id, before the search. One row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("runs", T._parse_datatype_string(RUN)), T.StructField("collapsed", T.BinaryType())])
    return rows.mapInArrow(_searched(change), schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The trial's texts: every tenth document by checksum repeats a stretch from some word to its end."""
    n = len(words)
    digest = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if digest % 10 or not n:
        return words
    group = digest // 10
    first = group % n
    period = 1 + (n - first) // (3 + group % 8)
    return words[:first] + [words[first + i % period] for i in range(n - first)]


def _greatest() -> Column:
    """The longest run; of equal ones the first, then the one of smallest period."""
    ranked = F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")))
    return F.array_max(ranked)


def run_report(docs: DataFrame) -> DataFrame:
    """The registered query's columns over ``docs`` with the trial's repeats."""
    found = periodic_runs(docs, planted).withColumn("best", _greatest())
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(F.expr("1000 * best.length div -best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
