"""SentencePiece encoding and decoding over a relational lattice.

A text becomes words (leading space marks and what follows up to the next one; a line feed is a word of
its own): no piece crosses such a place, which is checked when the piece table is read. Substrings of
each distinct word up to the longest piece are exploded and equi-joined to the piece table, and the edges are
grouped by word. For a unigram model a higher-order aggregate folds the lattice by Viterbi. The scores of a
BPE model are merge ranks, and the best path by them is not what its merges give. So there the same
edges are merged: one whose ends are bounds with a single bound between them joins its two parts, best
rank first, leftmost on a tie. As a higher-order aggregate that took 0.6 ms a word, so it is a small
loop in the task that puts the texts together.

Words are counted over all texts, and those used most, as many as FREQUENT_WORDS, go on the lattice once for the
whole corpus. Their ids are a table of bounded size, so tasks get it by broadcast and put the texts together
where they are read: no text is shuffled. Other words are encoded where they are met, by the same rule
over the same piece table, all new ones of a slice of rows together; a corpus with fewer distinct words has all of them on the lattice.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import stage

SPACE = "▁"
WORDS = f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
# Longer words (boundaries are bits of a long) are encoded where they are met.
LATTICE_CHARS = 62
# At most so many words are broadcast with their ids: about 30 MB in a Python worker.
FREQUENT_WORDS = 1 << 17
# Words that a task counts, or remembers besides the frequent ones, before it starts anew.
HELD_WORDS = 1 << 16
# Words that are merged together; with more of them the arrays leave the CPU's cache.
MERGED_WORDS = 1 << 13
# Rows that a task holds as Python objects at once.
SLICE_ROWS = 256
# Bytes of the rows that Spark hands to a task at once (its own limit of 64 MB holds many such slices).
BATCH_BYTES = 2 << 20
# Words on the lattice in one task: their edges, about 30 a word, are sorted in memory.
LATTICE_WORDS = 1 << 14
# Uses are told apart in steps of a sixteenth of a doubling when the frequent words are chosen.
STEPS = 16


@dataclass(frozen=True)
class Pieces:
    """A model's piece table. ``rank``: place in merge order, or minus the log probability."""

    pieces: list[str]
    rank: list[float]
    normal: list[bool]
    byte_base: int
    unknown: int
    unigram: bool

    @property
    def longest(self) -> int:
        return max((len(p) for p, ok in zip(self.pieces, self.normal) if ok), default=1)

    def rows(self) -> list[tuple[str, int, int]]:
        """(piece, id, place): the pieces in merge order; equal ranks share a place."""
        places = {r: i for i, r in enumerate(sorted({r for r, ok in zip(self.rank, self.normal) if ok}))}
        return [(p, i, places[r]) for i, (p, r, ok) in enumerate(zip(self.pieces, self.rank, self.normal)) if ok]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pd.DataFrame(self.rows(), columns=["piece", "id", "place"]), "piece string, id int, place int")

    def texts(self) -> list[bytes]:
        """What each id stands for: the byte of a byte piece, nothing for a control piece."""
        base = self.byte_base
        return [bytes([i - base]) if 0 <= base <= i < base + 256 else (p if ok else "").encode() for i, (p, ok) in enumerate(zip(self.pieces, self.normal))]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(model_file: str, unigram: bool = False) -> Pieces:
    """The piece table of a model file. Its kind is not told by the library, so the caller says."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=Path(model_file).read_bytes())
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids]
    normal = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in ids]
    crossing = [p for p, ok in zip(pieces, normal) if ok and (SPACE in p.lstrip(SPACE) or "\n" in p[1:] or "\n" in p[:-1])]
    if crossing:
        raise ValueError(f"pieces cross word ends: {crossing[:5]}")
    base = model.piece_to_id("<0x00>") if model.is_byte(model.piece_to_id("<0x00>")) else -1
    if base >= 0 and any(pieces[base + b] != f"<0x{b:02X}>" for b in range(256)):
        raise ValueError("byte pieces are not in order")
    return Pieces(pieces, [-model.get_score(i) for i in ids], normal, base, model.unk_id(), unigram)


def marked(text: Column) -> Column:
    """Spaces as marks and one mark in front; a null or empty text stays empty."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit("")).otherwise(F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE))))


def _fallback(char: Column, table: Pieces) -> Column:
    """Ids of a character that is no piece: its UTF-8 bytes, or the unknown id."""
    if table.byte_base < 0:
        return F.array(F.lit(table.unknown))
    data = F.hex(F.encode(char, "UTF-8"))
    count = (F.length(data) / 2).cast("int")
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.conv(F.substring(data, i * 2 - 1, F.lit(2)), 16, 10).cast("int") + table.byte_base)


# An edge is one number, so that grouping moves little: merge order, start, size, id from high to low bits.
_RANK, _START, _SIZE, _ID = 36, 30, 24, 24
_NO_PIECE = (1 << _ID) - 1  # the id of a single character that is no piece
_NO_RANK = (1 << 26) - 1


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _start(edge: Column) -> Column:
    return F.shiftright(edge, _START).bitwiseAND(F.lit(63)).cast("int")


def _end(edge: Column) -> Column:
    return _start(edge) + F.shiftright(edge, _SIZE).bitwiseAND(F.lit(63)).cast("int")


def _ends(edge: Column) -> Column:
    """The edge's two end points as bits."""
    return _bit(_start(edge)) + _bit(_end(edge))


def _inner(edge: Column) -> Column:
    """The points inside the edge as bits."""
    return _bit(_end(edge)) - _bit(_start(edge) + 1)


def lattice(words: DataFrame, table: Pieces, by: list[str]) -> DataFrame:
    """``by`` (which holds ``word``), edges: every piece in the word, as numbers. For a unigram model there is a
    way over each single character; merging needs pieces of two or more characters only."""
    most, least = table.longest, 1 if table.unigram else 2
    at = words.where(F.length("word") >= least).select(*by, F.explode(F.sequence(F.lit(0), F.length("word") - least)).alias("start"))
    spans = at.withColumn("size", F.explode(F.sequence(F.lit(least), F.least(F.lit(most), F.length("word") - F.col("start")))))
    spans = spans.withColumn("piece", F.substring(F.col("word"), F.col("start") + 1, F.col("size")))
    # The piece table is a fixed vocabulary, so its broadcast does not grow with the data.
    edges = spans.join(F.broadcast(table.frame(words.sparkSession)), "piece", "left" if table.unigram else "inner").where("id is not null or size = 1")
    place = lambda c, bits: F.call_function("shiftleft", c.cast("long"), F.lit(bits))
    edge = (
        place(F.coalesce("place", F.lit(_NO_RANK)), _RANK) + place(F.col("start"), _START) + place(F.col("size"), _SIZE)
        + F.coalesce("id", F.lit(_NO_PIECE)).cast("long")
    )
    return edges.groupBy(*by).agg(F.collect_list(edge).alias("edges"))


def _best_path(edges: Column, length: Column, table: Pieces) -> Column:
    """The Viterbi fold: the points of the path with the least total rank, as bits. The state holds, for
    each point reached, the total and the path; a tie goes to the longer last edge."""
    kind = "array<struct<cost:double,points:bigint>>"
    ranks = F.split(F.lit(",".join(map(repr, table.rank))), ",").cast("array<double>")
    cost = lambda e: F.coalesce(F.get(ranks, e.bitwiseAND(F.lit(_NO_PIECE)).cast("int")), F.lit(1e30))

    def step(best: Column, end: Column) -> Column:
        into = F.transform(
            F.filter(edges, lambda e: _end(e) == end),
            lambda e: F.struct((F.get(best, _start(e))["cost"] + cost(e)).alias("cost"), _start(e).alias("start"), F.get(best, _start(e))["points"].alias("points")),
        )
        least = F.array_min(into)
        return F.array_append(best, F.struct(least["cost"].alias("cost"), least["points"].bitwiseOR(_bit(end)).alias("points")))

    first = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(1).cast("long").alias("points"))).cast(kind)
    return F.aggregate(F.sequence(F.lit(1), length), first, step, lambda best: F.get(best, length)["points"])


def fold(latticed: DataFrame, table: Pieces, by: list[str]) -> DataFrame:
    """``by``, ids: the edges of the best path, in order. For unigram models."""
    kept = latticed.withColumn("_points", _best_path(F.col("edges"), F.length("word"), table))
    path = F.filter("edges", lambda e: (F.col("_points").bitwiseAND(_ends(e)) == _ends(e)) & (F.col("_points").bitwiseAND(_inner(e)) == 0))
    by_start = F.array_sort(F.transform(path, lambda e: F.struct(_start(e).alias("at"), e.bitwiseAND(F.lit(_NO_PIECE)).cast("int").alias("id"))))
    char = lambda e: F.substring(F.col("word"), e["at"] + 1, F.lit(1))
    ids = F.transform(by_start, lambda e: F.when(e["id"] == _NO_PIECE, _fallback(char(e), table)).otherwise(F.array(e["id"])))
    return kept.select(*by, F.flatten(ids).alias("ids"))


def merge_edges(word: str, edges: list[int], single) -> list[int]:
    """Ids of a short word by merging over its edges. ``points`` are the bounds left, as bits; an edge can
    merge when its ends are bounds with one bound between them. Sorted edges are in merge order."""
    spans = []
    for e in sorted(edges):
        start = e >> _START & 63
        end = start + (e >> _SIZE & 63)
        spans.append((1 << start | 1 << end, (1 << end) - (1 << start + 1), start, e & _NO_PIECE))
    points, wide = (1 << len(word) + 1) - 1, spans
    while wide:
        for ends, inner, _, _ in wide:
            between = points & inner
            if between and between & (between - 1) == 0:
                points ^= between
                break
        else:
            break
        wide = [x for x in wide if x[0] & points == x[0] and x[1] & points]
    merged = {start: i for ends, inner, start, i in spans if ends & points == ends and not inner & points}
    return [j for at in range(len(word)) if points >> at & 1 for j in ([merged[at]] if at in merged else single(word[at]))]


@dataclass(frozen=True)
class Merges:
    """Which neighbours merge, as numbers. A symbol is a piece's id or, from ``pieces`` on, a character that is only
    part of pieces; the last one, ``width - 1``, stands for all other characters and merges with nothing."""

    pieces: int
    width: int
    chars: np.ndarray  # code points, ascending
    symbols: np.ndarray  # of chars
    pairs: np.ndarray  # left symbol * width + right symbol, ascending
    places: np.ndarray  # of pairs in merge order
    merged: np.ndarray  # symbols that pairs become
    none: int  # the place of pairs that do not merge


def merges(table: Pieces) -> Merges:
    place = {p: (at, i) for p, i, at in table.rows()}
    symbol = {p: i for p, (_, i) in place.items()}
    for char in sorted({c for p in place for c in p} - symbol.keys()):
        symbol[char] = len(table.pieces) + len(symbol) - len(place)
    width = len(table.pieces) + len(symbol) - len(place) + 1
    pairs = [(symbol[p[:k]] * width + symbol[p[k:]], at, i) for p, (at, i) in place.items() for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
    chars = sorted((ord(c), i) for c, i in symbol.items() if len(c) == 1)
    # Each list ends with an entry that no text meets, so that a search always finds a place.
    keys, places, merged = np.array([*sorted(pairs), (width * width, 0, 0)], dtype=np.int64).T
    codes, symbols = np.array([*chars, (0x110000, 0)], dtype=np.int64).T
    return Merges(len(table.pieces), width, codes, symbols, keys, places, merged, len(place))


def merge_words(words: list[str], by: Merges, single) -> list[bytes]:
    """Ids (four bytes each) of many short words. In every round each word merges its neighbours of best place,
    leftmost on a tie; words without any leave."""
    text = "".join(words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(codes):
        return [b""] * len(words)

    def found(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * by.width + right
        i = np.searchsorted(by.pairs, keys)
        return np.where(by.pairs[i] == keys, by.places[i], by.none), by.merged[i]

    i = np.searchsorted(by.chars, codes)
    symbols = np.where(by.chars[i] == codes, by.symbols[i], by.width - 1)
    word_at = np.repeat(np.arange(len(words)), [len(w) for w in words])
    at, word = np.arange(len(codes)), word_at
    place, into = found(symbols, np.append(symbols[1:], by.width - 1))
    place[:-1][word[1:] != word[:-1]] = by.none
    left = []
    while n := len(symbols):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(place * n + np.arange(n), first)
        merging = best < by.none * n
        kept = np.repeat(merging, np.diff(np.append(first, n)))
        left.append((at[~kept], symbols[~kept]))
        i = best[merging] % n
        symbols[i] = into[i]
        kept[i + 1] = False
        i = np.cumsum(kept)[i] - 1
        at, symbols, word, place, into = (x[kept] for x in (at, symbols, word, place, into))
        if len(i):
            near = np.append(i, i[i > 0] - 1)
            after = np.minimum(near + 1, len(symbols) - 1)
            places, into[near] = found(symbols[near], symbols[after])
            place[near] = np.where((after > near) & (word[near] == word[after]), places, by.none)
    at, symbols = (np.concatenate(x) for x in zip(*left))
    order = np.argsort(at)
    at, symbols = at[order], symbols[order]
    ends = np.append(0, np.cumsum(np.bincount(word_at[at], minlength=len(words))))
    data = symbols.astype(np.int32).tobytes()
    out = [data[4 * a : 4 * b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
    for w in np.unique(word_at[at[symbols >= by.pieces]]).tolist():
        parts = zip(at[ends[w] : ends[w + 1]].tolist(), symbols[ends[w] : ends[w + 1]].tolist())
        out[w] = np.array([j for a, s in parts for j in ([s] if s < by.pieces else single(text[a]))], dtype=np.int32).tobytes()
    return out


def encode_long(word: str, rank: dict[str, tuple[float, int]], fallback, unigram: bool, longest: int) -> list[int]:
    """One long word, by a heap of possible merges or a running best path."""
    n = len(word)
    if unigram:
        best, back = [0.0] + [float("inf")] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                cost = rank[word[start:end]][0] if word[start:end] in rank else 1e30 if end - start == 1 else None
                if cost is not None and best[start] + cost < best[end]:
                    best[end], back[end] = best[start] + cost, start
        cuts, at = [n], n
        while at:
            at = back[at]
            cuts.append(at)
        spans = list(zip(cuts[::-1], cuts[-2::-1]))
    else:
        end_of, before, heap = list(range(1, n + 1)), list(range(-1, n)), []

        def offer(a: int) -> None:
            b = end_of[a]
            if b < n and end_of[b] - a <= longest and (found := rank.get(word[a : end_of[b]])):
                heapq.heappush(heap, (found[0], a, b, end_of[b]))

        alive = [True] * n
        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if not (alive[a] and end_of[a] == b and b < n and alive[b] and end_of[b] == c):
                continue
            end_of[a], alive[b] = c, False
            if c < n:
                before[c] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        spans = [(a, end_of[a]) for a in range(n) if alive[a]]
    return [i for a, b in spans for i in ([rank[word[a:b]][1]] if word[a:b] in rank else fallback(word[a:b]))]


def _encoders(table: Pieces):
    """What tasks need of the table: a way to encode any words, and one for a single character."""
    rank = {p: (r, i) for i, (p, r, ok) in enumerate(zip(table.pieces, table.rank, table.normal)) if ok}
    base, unknown, unigram, longest = table.byte_base, table.unknown, table.unigram, table.longest

    def fallback(char: str) -> list[int]:
        return [base + b for b in char.encode("utf-8", "surrogatepass")] if base >= 0 else [unknown]

    def single(char: str) -> list[int]:
        return [rank[char][1]] if char in rank else fallback(char)

    by = None if unigram else merges(table)

    def rest(words: list[str]) -> list[bytes]:
        apart = [w for w in words if unigram or len(w) > LATTICE_CHARS]
        ids = {w: np.array(encode_long(w, rank, fallback, unigram, longest), dtype=np.int32).tobytes() for w in apart}
        short = [w for w in words if w not in ids]
        if short:
            ids.update(zip(short, merge_words(short, by, single)))
        return [ids[w] for w in words]

    return rest, single


_WORDS = regex.compile(WORDS)


def words_of(text: str | None) -> list[str]:
    """The words of a text, and empty ones between them."""
    if not text:
        return []
    if text[0] == " " or "  " in text or SPACE in text or "\0" in text:
        return _WORDS.findall(SPACE + text.replace(" ", SPACE))
    # Every space begins a word, so cutting before spaces and around line feeds gives the same, much faster.
    return (SPACE + text).replace(" ", "\0" + SPACE).replace("\n", "\0\n\0").split("\0")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, uses) of a task's texts; a word may come more than once."""
    uses: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": list(uses), "uses": list(uses.values())}, pa.schema([("word", pa.string()), ("uses", pa.int64())]))
        uses.clear()
        return out

    for batch in _slices(batches):
        for text in batch.column("text").to_pylist():
            uses.update(words_of(text))
            if len(uses) >= HELD_WORDS:
                yield flush()
    yield flush()


def frequent_words(docs: DataFrame, most: int = FREQUENT_WORDS) -> DataFrame:
    """word, uses: the lattice's words that are used most in all texts, at most ``most`` of them.

    The least number of uses comes from a histogram in steps, so nothing is sorted and the rows that
    reach the driver are bounded."""
    uses = docs.select("text").mapInArrow(_counted, "word string, uses bigint").groupBy("word").agg(F.sum("uses").alias("uses"))
    step = F.floor(F.log2("uses") * STEPS).cast("int")
    uses = stage(uses.where(F.length("word").between(1, LATTICE_CHARS)).withColumn("step", step), "piece-words")
    least, words = 64 * STEPS, 0
    for at, n in sorted(uses.groupBy("step").count().collect(), reverse=True):
        words += n
        if words > most:
            break
        least = at
    return uses.where(F.col("step") >= least).select("word", "uses")


def _merged(single):
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [merge_edges(w, e, single) for w, e in zip(batch.column("word").to_pylist(), batch.column("edges").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    return merged


def word_ids(words: DataFrame, table: Pieces) -> DataFrame:
    """word, ids: every one of ``words`` (distinct) that holds a piece, by its lattice."""
    parts = max(1, -(-words.count() // LATTICE_WORDS))
    known = lattice(words.select("word").repartition(parts, "word"), table, ["word"])
    return fold(known, table, ["word"]) if table.unigram else known.mapInArrow(_merged(_encoders(table)[1]), "word string, ids array<int>")


def _assemble(keep: list[str], known: Broadcast, rest):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, met = known.value, {}
        for batch in _slices(batches):
            texts = [words_of(t) for t in batch.column("text").to_pylist()]
            if len(met) >= HELD_WORDS:
                met.clear()
            new = list({w for words in texts for w in words if w not in ids and w not in met})
            for i in range(0, len(new), MERGED_WORDS):
                met.update(zip(new[i : i + MERGED_WORDS], rest(new[i : i + MERGED_WORDS])))
            rows = [b"".join([ids[w] if w in ids else met[w] for w in words]) for words in texts]
            ends = np.cumsum([0, *map(len, rows)]) // 4
            lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, lists.cast(pa.list_(pa.int32()))], [*keep, "ids"])

    return assemble


def encode(docs: DataFrame, table: Pieces, keep: list[str] | None = None, most: int = FREQUENT_WORDS) -> DataFrame:
    """The columns ``keep`` (default: all) of every row with ``ids``, the piece ids of the whole text.

    Null and empty texts have no ids. Rows stand alone: repeated rows and null ids are encoded like any.
    A column named ``ids`` is replaced. ``most`` decides where words are encoded, never what they give.
    The session's Arrow batches are limited to BATCH_BYTES, for this plan and those after it.
    """
    keep = [c for c in (keep or docs.columns) if c != "ids"]
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    known = word_ids(frequent_words(docs, most), table).select("word", "ids").toArrow()
    ids = {w: np.array(i, dtype=np.int32).tobytes() for w, i in zip(known["word"].to_pylist(), known["ids"].to_pylist())}
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(_assemble(keep, docs.sparkSession.sparkContext.broadcast(ids), _encoders(table)[0]), schema)


def _restored(keep: list[str], texts: list[bytes]):
    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.array(texts, dtype=object)
        for batch in _slices(batches):
            lists = batch.column("ids")
            ends, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
            out = [b"".join(of[ids[a:b]]).decode(errors="replace").replace(SPACE, " ")[1:] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.string())], [*keep, "decoded"])

    return restored


def decode(encoded: DataFrame, table: Pieces) -> DataFrame:
    """All columns, and ``decoded``: the text of ``ids`` (all bytes in a row, read as UTF-8, marks as spaces,
    the front one dropped). Null and empty lists give an empty text; a column named ``decoded`` is replaced."""
    keep = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*keep).withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(_restored(keep, table.texts()), schema)


def encoding_report(docs: DataFrame, table: Pieces) -> DataFrame:
    """doc_id, n_ids, ids, and whether decoding gives the text again (a null one as empty). A text that
    holds the space mark itself comes back with spaces and counts as not restored."""
    out = decode(encode(docs.select("doc_id", "text"), table), table)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", same.alias("restored"))
