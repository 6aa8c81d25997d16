"""Merkle manifest, packing and periodic runs against plain versions on small tables."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martloom.llm import best_fit_packing, merkle_manifest, periodic_runs

DOCS = "doc_id long, text string, source string, lang string, n_chars long, tree string, idx string, levels int, digest string, path string, runs string, collapsed string, best string, length string, _row string, _at string, _rank string"
CLASH = ("x", "y", 7, "z", "p", "r", "c", "b", "l", "row", "at", "rank")


def sample(n, seed=5):
    """Rows with nulls, empty and long texts, repeated rows, many sources of very unequal size."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{rng.randrange(1 + i % 40)}" for _ in range(rng.randrange(60))]
        text = rng.choice(["\n", " ", "  "]).join(words) + rng.choice(["", "\n", " ü日本😀"])
        out.append((i * 7, text, rng.choice(["hot", "hot", "hot", "b", "é", None, f"s{i % 5}"]), rng.choice(["en", None]), len(text), *CLASH))
    out += [(None, "no id\n", "hot", None, None, *CLASH), (None, None, None, None, None, *CLASH), (7000, None, "b", "en", 0, *CLASH), (7001, "", "b", "en", 0, *CLASH)]
    out += [(7002, "a b c d " * 3000 + "\nend", "hot", "en", 1, *CLASH), (-3, "<|endoftext|> x", "b", "en", 2, *CLASH)]
    return out + [out[3], out[3], out[5]]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """The contract's columns, one tree after the other, with paths walked leaf by leaf."""

    def leaf(doc, source, lang, chars, text):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, chars, text)))

    def grow(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def siblings(levels, i):
        for level in levels[:-1]:
            run = i // 3 * 3
            yield level[run:i], level[i + 1 : run + 3]
            i //= 3

    by = {}
    for doc, text, source, lang, chars, *_ in rows:
        by.setdefault(source, []).append((doc is not None, doc or 0, leaf(doc, source, lang, chars, text), (doc, source, lang, chars, text)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grow([r[2] for r in sorted(by[s], key=lambda r: r[:3])]) for s in order}
    top = grow([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, (*_, digest, fields) in enumerate(sorted(by[s], key=lambda r: r[:3])):
            path = [*siblings(trees[s], i), *siblings(top, at)]
            doc, text = fields[0], fields[4]
            now = digest
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                now = leaf(*fields[:4], text.replace("\n", ""))
            for left, right in path:
                now = h(*left, now, *right)
            proof = h(*(d for left, right in path for d in left + right))
            out.append((doc, digest, trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n, block", [(0, 1), (1, 2), (120, 1), (120, 2), (400, 6)])
def test_manifest(make, monkeypatch, n, block):
    monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", block)
    rows = sample(n) if n else []
    got = merkle_manifest.manifest_report(make(DOCS, rows).repartition(3))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_manifest(rows)


def test_manifest_of_one_row_and_of_any_order(make):
    row = [(4, "a\nb", None, None, None, *CLASH)]
    (r,) = merkle_manifest.manifest_report(make(DOCS, row)).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == h()
    rows = sample(60)
    one, two = (merkle_manifest.manifest_report(make(DOCS, rs).repartition(k)).collect() for rs, k in ((rows, 2), (rows[::-1], 5)))
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_versions_copy_only_ancestors(make, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", 2)
    docs = make(DOCS, sample(200))
    made = merkle_manifest.versions(docs, merkle_manifest.without_line_ends()).collect()
    original = {d for r in made if not r["tampered"] for d in r["path"]}
    for r in made:
        rows_of_source = sum(m["source"] == r["source"] for m in made)
        sources = len({m["source"] for m in made})
        levels = lambda n: next(k for k in range(20) if 3**k >= n)
        assert len(r["path"]) == 1 + levels(rows_of_source) + levels(sources)
        if r["tampered"] and r["path"][0] != r["leaf"]:
            assert not original & set(r["path"])


def unpacked(histogram, capacity, groups):
    """The lengths in each sequence, checked to be gapless and every piece placed once."""
    places, n = best_fit_packing.plan(histogram, capacity, groups)
    lengths = [length for length in sorted(histogram) for _ in range(histogram[length])]
    bins, seen = {}, []
    for p in places:
        for k in range(p.pieces):
            assert lengths[p.first + k] == p.length
            bins.setdefault(p.sequence + k // p.each, []).append((p.offset + k % p.each * p.length, p.length))
            seen.append(p.first + k)
    assert sorted(seen) == list(range(len(lengths))) and sorted(bins) == list(range(n))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return n, -(-sum(lengths) // capacity)


def test_plans_place_every_piece_once():
    rng = random.Random(2)
    assert best_fit_packing.plan({}) == ([], 0)
    for _ in range(150):
        capacity, histogram = rng.choice([8, 16, 50, 100]), {}
        for _ in range(rng.randrange(200)):
            length = rng.randrange(1, capacity + 1)
            histogram[length] = histogram.get(length, 0) + rng.choice([1, 1, 30])
        unpacked(histogram, capacity, rng.choice([1, 3, 10, 100]))


def test_configurations_beat_best_fit():
    histogram = {51: 600, 27: 600, 26: 600, 23: 1200}  # 600 of 51 + 26 + 23 and 300 of 27 + 27 + 23 + 23 leave nothing over
    n, least = unpacked(histogram, 100, 100)
    free = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [i for i, f in enumerate(free) if f >= length]
            if not fits:
                free.append(100)
                fits = [len(free) - 1]
            i = min(fits, key=lambda i: free[i])
            free[i] -= length
    assert least == 900 and len(free) >= 1100 and n <= 910


def test_packing_of_documents(make):
    definition = best_fit_packing.default_tokenizer()
    tokenizer = Tokenizer.from_str(definition)
    rows = sample(80)
    docs = make(DOCS, rows).repartition(3)
    got = best_fit_packing.packing_report(docs, definition)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    wanted = []
    for doc, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        start = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(start, len(ids) + 1, 1024)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted.append((doc, n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    out = got.collect()
    assert sorted((tuple(r)[:5] for r in out), key=repr) == sorted(wanted, key=repr)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        ends = np.cumsum([0] + [b for _, b in sorted(parts)]).tolist()
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024
    assert len(bins) <= 1.1 * sum(r["length"] for r in out) / 1024 + 1
    assert best_fit_packing.packing_report(make(DOCS, []), definition).count() == 0


def test_sequences_hold_the_documents_ids(make):
    definition = best_fit_packing.default_tokenizer()
    docs = make(DOCS, sample(30)).select("doc_id", "text").where("doc_id != 21")
    packed = best_fit_packing.pack(best_fit_packing.stage(best_fit_packing.cut_documents(docs, definition, 64, with_ids=True), "pieces"), 64)
    whole = {r["sequence_id"]: r["ids"] for r in best_fit_packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert sum(map(len, whole.values())) == packed.agg(F.sum("length")).first()[0]


def plain_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)  # a smaller period of the same stretch was met before
            i = j + 1
    return sorted(((a, b - a, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng, n):
    words = [rng.randrange(rng.choice([1, 2, 3, 5, 50])) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 4:
            a = rng.randrange(n)
            p, b = rng.randrange(1, max(2, (n - a) // 3 + 1)), rng.randrange(a, n) + 1
            for i in range(a, b):
                words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("primes", [periodic_runs.PRIMES, periodic_runs.PRIMES[1:]])
def test_runs_match_plain_version(monkeypatch, primes):
    monkeypatch.setattr(periodic_runs, "PRIMES", primes)
    rng = random.Random(1)
    texts = [repetitive(rng, rng.randrange(90)) for _ in range(1500)] + [repetitive(rng, 900) for _ in range(6)] + [[1] * 700, [1, 2] * 400, []]
    for at in range(0, len(texts), 131):
        part = texts[at : at + 131]
        found = periodic_runs.find_runs([periodic_runs.numbered([b"%d" % w for w in t]) for t in part])
        assert found == [plain_runs(t) for t in part]


@pytest.mark.parametrize("size", [1, 2, 4, 64, 512])
@pytest.mark.parametrize("top", [3, 10**4, 10**8])
def test_occurrences_are_exact(size, top):
    """Numbers up to 10^8 need several primes; one prime alone would let multiples of it pass."""
    rng = np.random.default_rng(size)
    cells = rng.integers(0, top, size=(3 * size, 20))
    for column in range(0, 20, 2):
        lag = int(rng.integers(0, size))
        cells[size + lag : 2 * size + lag, column] = cells[:size, column]
    cells[size : 2 * size, 1] = cells[:size, 1]
    cells[size, 1] += periodic_runs.PRIMES[0]  # differs by a multiple of the prime
    column, lag = periodic_runs.occurrences(cells)
    wanted = [(c, d) for c in range(20) for d in range(size) if (cells[:size, c] == cells[size + d : 2 * size + d, c]).all()]
    assert list(zip(column.tolist(), lag.tolist())) == wanted


def test_run_report(make):
    rows = sample(250)
    rows += [(90000 + i, "a b " * 40, "b", "en", 1, *CLASH) for i in range(3)] + [(91000, "x " * 5, "b", "en", 1, *CLASH), (91001, "x " * 6, "b", "en", 1, *CLASH)]
    got = periodic_runs.run_report(make(DOCS, rows).repartition(3))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    wanted = []
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        n = len(words)
        digest = zlib.crc32(str(doc).encode())
        if doc is not None and digest % 10 == 0 and n:
            a = digest // 10 % n
            p = 1 + (n - a) // (3 + digest // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lost = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in lost)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        wanted.append((doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None, h(lines), hashlib.sha256(kept).hexdigest()))
    assert sum(w[1] > 0 for w in wanted) > 20
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(wanted, key=repr)
    assert periodic_runs.run_report(make(DOCS, [])).count() == 0
