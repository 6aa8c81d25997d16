"""The quadratic discriminant against a plain version: statistics character by character, densities by solving."""

import math
import random
import zlib

import numpy as np

from martloom.llm import quality_qda as qda


def plain_statistics(text):
    white = " \t\n\v\f\r"
    data = (text or "").encode()
    chars = data.decode("latin-1")
    words, word = [], ""
    for c in chars + " ":
        if c in white:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return [0.0] * qda.WIDTH
    inked = [c for c in chars if c not in white]
    share = lambda f: math.sqrt(sum(map(f, inked)) / len(inked))
    upper, lower = sum("A" <= c <= "Z" for c in chars), sum("a" <= c <= "z" for c in chars)
    lines = [x for x in chars.split("\n") if any(c not in white for c in x)]
    return [
        math.log(1 + len(words)), math.log(len(inked) / len(words)), share(lambda c: c in "#*$%&<>~^_=+@\\{}[]"), share(lambda c: c in ".,;:?\"'()-"),
        share(lambda c: c == "!"), share(lambda c: c == "|"), math.sqrt(upper / max(1, upper + lower)), share(lambda c: c.isascii() and c.isdigit()),
        share(lambda c: ord(c) > 127), math.sqrt(1 - len(inked) / len(chars)), math.log(1 + len(set(words))) / math.log(1 + len(words)),
        math.sqrt(max(words.count(w) for w in set(words)) / len(words)) if len(words) >= 8 else 0.0,
        math.sqrt(sum(words[i] == words[i - 1] for i in range(1, len(words))) / len(words)), math.sqrt(1 - len(set(lines)) / len(lines)),
        math.log(1 + len(words) / len(lines)), math.sqrt(sum(w[-1] in "#*$%&!|<>" for w in words) / len(words)),
    ]


def plain_scores(stats, rows):
    """Class 1's share in two normal densities, with shrunk covariances; ``rows``: (statistics, label) to learn from."""
    x, y = np.array([s for s, _ in rows]), np.array([label for _, label in rows])
    centre, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1
    z = (x - centre) / spread
    cov = {k: np.cov(z[y == k].T, bias=True) for k in (0, 1)}
    pooled = ((y == 0).sum() * cov[0] + (y == 1).sum() * cov[1]) / len(y)
    out = []
    for s in (np.array(stats) - centre) / spread:
        density = {}
        for k in (0, 1):
            c = (1 - qda.TOWARDS_POOLED) * cov[k] + qda.TOWARDS_POOLED * pooled
            c = c + qda.TOWARDS_DIAGONAL * (np.diag(np.diag(c)) - c) + qda.FLOOR * np.eye(qda.WIDTH)
            d = s - z[y == k].mean(axis=0)
            density[k] = -0.5 * d @ np.linalg.solve(c, d) - 0.5 * np.linalg.slogdet(c)[1]
        odds = (density[1] - density[0]) / qda.TEMPERATURE + math.log(y.mean() / (1 - y.mean()))
        out.append(1 / (1 + math.exp(-max(-500, min(500, odds)))))
    return out


def texts(n):
    rng = random.Random(3)
    good = "the report of a long day, said Ann; and it was (not) over: 12 lines é".split()
    bad = "BUY now!!! $$$ win | win | #deal 99% click> click>".split()
    for i in range(n):
        pool = good if i % 3 else bad + good[:4]
        yield rng.choice(["\n", " "]).join(" ".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6)))


def test_statistics_match_plain_version():
    for text in [None, "", " \n", "x", "É\v\fé " * 9, "a\x1cb \x85 c\n\n!\n!", *texts(60)]:
        assert np.allclose(qda.statistics(text), plain_statistics(text), rtol=1e-12, atol=1e-12)


def test_scores_match_plain_version(make):
    rows = [(i, t) for i, t in enumerate(texts(150))] + [(150, None), (151, ""), (3, "again"), (None, "no id"), (152, "word " * 30_000)]
    labels = [(i, int(i % 3 > 0)) for i in range(150)] + [(0, 0), (150, None), (151, 7), (None, 1)]
    got = qda.classify(make("doc_id bigint, text string", rows), make("doc_id bigint, quality int", labels)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    known = {(i, label) for i, label in labels if label in (0, 1) and i is not None and not held(i)}
    learn = [(plain_statistics(t), label) for i, t in rows for j, label in known if i == j]
    expected = dict(zip(rows, plain_scores([plain_statistics(t) for _, t in rows], learn)))
    assert len(got) == len(rows)
    for r in got:
        assert abs(r["score"] - expected[r["doc_id"], r["text"]]) < 1e-6
        assert r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == held(r["doc_id"])
