"""Quality rules by line labelling: a linear-chain CRF marks lines as content or boilerplate.

Each line with a word gets a few shares as features. A two-state chain with learned emission and
transition weights is decoded by Viterbi over all lines of a text; the share of words in content lines
decides. The chain is fitted on the driver, on all lines of a bounded sample of labelled documents (SAMPLE and
FIT_LINES lines per label; documents are taken whole or not at all): all lines of a good document count as
content, all of a bad one as boilerplate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import staged_with_row
from martloom.llm.quality_qda import held_out

SAMPLE = 1000  # labelled documents per label that the chain is fitted on
FIT_LINES = 500_000  # their lines in total, per label
LONGEST = 20_000  # a document of more lines is not sampled
STEPS = 200
RATE = 2.0
RIDGE = 1e-3
CONTENT_SHARE = 0.5
# Base rules: least words and most repeated words, in percent.
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8

LINE_FEATURES = ["bias", "symbol", "bang", "pipe", "upper", "digit", "same_word", "marked_words", "distinct", "short"]
_DROP_SYMBOLS = b"#*$%&<>~^_=+@\\{}[]"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_MARKS = frozenset(b"#*$%&!|<>")


def line_features(line: bytes) -> list[float]:
    words = line.split()
    n, size = len(words), len(line)
    share = lambda chars: (size - len(line.translate(None, chars))) / size
    upper, lower = share(_UPPER), share(_LOWER)
    same = sum(1 for a, b in zip(words, words[1:]) if a == b)
    return [
        1.0,
        min(1.0, 5 * share(_DROP_SYMBOLS)),
        min(1.0, 5 * line.count(b"!") / size),
        min(1.0, 5 * line.count(b"|") / size),
        upper / max(upper + lower, 1e-9) if n > 2 else 0.0,
        share(_DIGIT),
        same / n,
        sum(1 for w in words if w[-1] in _MARKS) / n,
        len(set(words)) / n,
        1.0 if n <= 2 else 0.0,
    ]


def lines_of(text: str | None) -> list[bytes]:
    """Lines with a word."""
    return [x for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if x.split()]


@dataclass(frozen=True)
class Chain:
    """State 1 is content. ``emit``: weights of content against boilerplate; ``stay``: gain of keeping
    the state; ``first``: weight of starting as content."""

    emit: np.ndarray
    stay: float
    first: float

    def label(self, features: list[list[float]]) -> list[int]:
        """Viterbi; a tie goes to content."""
        if not features:
            return []
        gains = (np.array(features) @ self.emit).tolist()
        good, bad, back = gains[0] + self.first, 0.0, []
        for g in gains[1:]:
            from_good = (good + self.stay >= bad, good > bad + self.stay)  # predecessor is content, for content and boilerplate
            back.append(from_good)
            good, bad = (good + self.stay if from_good[0] else bad) + g, (good if from_good[1] else bad + self.stay)
        state = int(good >= bad)
        out = [state]
        for to_good, to_bad in reversed(back):
            state = int(to_good if state else to_bad)
            out.append(state)
        return out[::-1]


def fit_chain(sequences: list[np.ndarray], labels: list[int]) -> Chain:
    """Conditional likelihood by gradient ascent; every line of a sequence has the sequence's label."""
    width = len(LINE_FEATURES)
    if len(set(labels)) < 2:
        return Chain(np.zeros(width), 0.0, 0.0)  # nothing to learn from: every line is content
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    sequences, y = [sequences[i] for i in order], np.array([labels[i] for i in order], dtype=float)
    lengths = np.array([len(s) for s in sequences])
    longest = int(lengths.max())
    # Lines lie one after the other, first all first lines, then all second ones: no padding to the longest sequence.
    # Sequences are sorted, so the first active[t] reach line t.
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    at = np.concatenate([[0], np.cumsum(active)])
    total = int(at[-1])
    x, owner, line = np.empty((total, width)), np.empty(total, dtype=np.int64), np.repeat(np.arange(longest), active)
    for i, s in enumerate(sequences):
        places = at[: len(s)] + i
        x[places], owner[places] = s, i
    before = (at[np.maximum(line - 1, 0)] + owner)[active[0] :]  # place of the line before, for all but first lines
    weight = (np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) / lengths)[owner]  # labels count alike
    y = y[owner]
    emit, stay, first = np.zeros(width), 0.0, 0.0
    for _ in range(STEPS):
        g = x @ emit
        forward = g.copy()  # log odds of content given the lines so far, emission included
        forward[: active[0]] += first
        for t in range(1, longest):
            p = forward[at[t - 1] : at[t - 1] + active[t]]
            forward[at[t] : at[t + 1]] += np.logaddexp(p + stay, 0) - np.logaddexp(p, stay)
        backward = np.zeros(total)
        for t in range(longest - 2, -1, -1):
            q = g[at[t + 1] : at[t + 2]] + backward[at[t + 1] : at[t + 2]]
            backward[at[t] : at[t] + active[t + 1]] = np.logaddexp(q + stay, 0) - np.logaddexp(q, stay)
        content = 1 / (1 + np.exp(-(forward + backward)))
        f, q = forward[before], (g + backward)[active[0] :]
        # Chance that neighbours agree: (1,1) and (0,0) against (1,0) and (0,1)
        agree = np.logaddexp(f + q + stay, stay)
        same = np.exp(agree - np.logaddexp(agree, np.logaddexp(f, q)))
        error = (y - content) * weight
        emit = emit + RATE * (error @ x - RIDGE * emit)
        stay = stay + RATE * (float(((1 - same) * weight[active[0] :]).sum()) - RIDGE * 10 * stay)
        first = first + RATE * (float(error[: active[0]].sum()) - RIDGE * first)
    return Chain(emit, float(stay), float(first))


def fit_on_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Fit on at most ``sample`` documents per label and FIT_LINES of their lines, those first by a checksum of
    their id, each with all its lines; held-out ids and documents of over LONGEST lines aside."""
    known = labels.where("quality in (0, 1)").select("doc_id", "quality").distinct().where(~held_out(F.col("doc_id")))
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    of_label = [known.where(F.col("quality") == label).orderBy(order, "doc_id").limit(sample) for label in (0, 1)]
    chosen = of_label[0].unionByName(of_label[1])

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.array([line_features(x) for x in lines_of(t)], dtype=np.float64).tobytes())

    width = len(LINE_FEATURES)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", order.alias("o"), features("text").alias("lines"))
    n = (F.length("lines") / F.lit(8 * width)).cast("int")
    found = staged_with_row(joined.withColumns({"n": n, "digest": F.md5("lines")}).where(F.col("n").between(1, LONGEST)), "crf-lines")
    # Repeated ids could make more rows than were chosen, so the bound is set again on the rows, by their counts and digests.
    narrow = found.select("quality", "o", "digest", "_row", "n").orderBy("o", "digest", "_row").limit(2 * sample).collect()
    so_far, kept = {0: 0, 1: 0}, []
    for r in narrow:
        so_far[r["quality"]] += r["n"]
        if so_far[r["quality"]] <= FIT_LINES:
            kept.append(r["_row"])
    rows = found.where(F.col("_row").isin(kept)).select("quality", "o", "lines").collect() if kept else []
    rows = sorted(rows, key=lambda r: (r["o"], bytes(r["lines"])))
    return fit_chain([np.frombuffer(r["lines"]).reshape(-1, width) for r in rows], [r["quality"] for r in rows])


def repeated_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that occur twice or more. Windows are compared exactly: numbers
    of words, then of pairs, of fours, of eights."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    for step in (1, 2, 4):
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1]
    repeated = np.bincount(ids)[ids] > 1
    if not repeated.any():
        return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[: len(ids)] += repeated
    edge[WINDOW : WINDOW + len(ids)] -= repeated
    return int((np.cumsum(edge)[: len(words)] > 0).sum())


def measure(text: str | None, chain: Chain) -> dict:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    points = len(data) - int(counts[128:192].sum())  # bytes that begin a code point
    lines = [x for x in data.split(b"\n") if x.split()]
    labels = chain.label([line_features(x) for x in lines])
    content = sum(len(x.split()) for x, good in zip(lines, labels) if good)
    repeats = repeated_words(words)
    failed = len(words) < LEAST_WORDS or 100 * repeats > MOST_REPEATED * len(words)
    share = content / len(words) if words else 0.0
    return {
        "n_words": len(words),
        "word_chars": points - int(counts[9:14].sum() + counts[32]),
        "n_symbols": int(sum(counts[c] for c in b"#*$%&|<>")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": not failed and share >= CONTENT_SHARE,
        "content_share": share,
        "line_labels": "".join(map(str, labels)),
    }


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, line_labels string"


def label_lines(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with ``rules``: the counts, the verdict, and a 0/1 for each line with a word.

    A null or empty text has no words and fails the base rules. Rows stand alone; a column ``rules`` is
    replaced.
    """

    @F.pandas_udf(RESULT)
    def measured(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pd.DataFrame([measure(t, chain) for t in texts], columns=names)

    return docs.withColumn("rules", measured(F.col("text")))


def rule_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    chain = fit_on_labels(docs, labels)
    out = label_lines(docs.select("doc_id", "text"), chain)
    return out.select("doc_id", *[f"rules.{c.split()[0]}" for c in RESULT.split(", ") if not c.startswith("line_labels")])
