"""Secret scan with multipart credential linking.

Strong finds (an assignment, an access id, a long hex run) stand alone. Weak parts (a user name, an
e-mail address, a short labelled value, a mixed token, an endpoint) are common in clean text, so they
are reported only together: a weak secret needs an identifier near it, a weak identifier a secret,
an endpoint both. "Near" is within REACH characters in the same scope (a block between blank lines).

Linking is an interval join on (row, scope, bin) with bins of REACH characters. A part is in every bin from its
start to its end. Per bin and role only the smallest start and the largest end are kept, which decides the join
exactly: a part too early and one too late are over two reaches apart, so they share no bin. No pairs of parts are
ever written out.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import stage

# Base patterns and least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

# The method's own weak parts.
IDENT = r"""(?:user_?name|user|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]+"""
EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
LABEL = r"""(?:pwd|passphrase|credential|private_?key|auth)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ENDPOINT = r"""https?://[^\x00-\x20"'<>]+|(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]+)?"""
REACH = 200
MASK = "[secret]"

# In the order in which kinds with the same start are listed.
KINDS = ["assign", "access", "hex", "ident", "email", "label", "token", "endpoint"]
BASE_KINDS = 3
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "ident": "identifier", "email": "identifier", "label": "secret", "token": "secret", "endpoint": "endpoint"}

_PARTS = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("kind", "start", "end", "scope")]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strong finds; positions are code points, ends exclusive."""
    out = []
    if "=" in text or ":" in text:
        out += [(0, *m.span()) for m in _RE["assign"].finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(1, *m.span()) for m in _RE["access"].finditer(text)]
    out += [(2, *m.span()) for m in _RE["hex"].finditer(text)]
    return out


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak parts outside the strong finds. Without any identifier nothing can link, so the
    others aren't looked for."""
    out = [(4, *m.span()) for m in _RE["email"].finditer(text)] if "@" in text else []
    if "=" in text or ":" in text:
        out += [(3, *m.span()) for m in _RE["ident"].finditer(text)]
    if not out and not any(kind == 1 for kind, _, _ in base):
        return []
    out += [(5, *m.span()) for m in _RE["label"].finditer(text)]
    out += [(6, *m.span()) for m in _RE["token"].finditer(text) if all(p.search(m[0]) for p in _MIXED)]
    out += [(7, *m.span()) for m in _RE["endpoint"].finditer(text)]
    taken, free, at, top = sorted((s, e) for _, s, e in base), [], 0, 0
    for kind, s, e in sorted(out, key=lambda x: (x[1], x[2])):
        while at < len(taken) and taken[at][0] <= s:  # strong finds that begin no later
            top, at = max(top, taken[at][1]), at + 1
        if top <= s and not (at < len(taken) and taken[at][0] < e):
            free.append((kind, s, e))
    return free


# A run of the class is matched whole, so asking for the least length in the pattern is the same.
_RE = {
    "assign": re.compile(ASSIGN, re.I | re.A),
    "access": re.compile(ACCESS.replace("+", "{16,}")),
    "hex": re.compile(HEX.replace("+", "{24,}")),
    "ident": re.compile(IDENT, re.I | re.A),
    "email": re.compile(EMAIL),
    "label": re.compile(LABEL, re.I | re.A),
    "token": re.compile(TOKEN),
    "endpoint": re.compile(ENDPOINT),
}
_MIXED = [re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")]
_BLANK = re.compile(r"\n[\x20\t\r]*\n")


def parts_of(text: str | None) -> list[dict]:
    if not text:
        return []
    base = base_spans(text)
    found = sorted(base + weak_spans(text, base), key=lambda x: (x[1], x[0]))
    breaks = [m.start() for m in _BLANK.finditer(text)] if found else []
    out, scope = [], 0
    for kind, s, e in found:
        while scope < len(breaks) and breaks[scope] < s:
            scope += 1
        out.append({"kind": kind, "start": s, "end": e, "scope": scope})
    return out


@F.pandas_udf(_PARTS)
def _parts(texts: pd.Series) -> pd.Series:
    return texts.map(parts_of)


def _linked(parts: DataFrame) -> DataFrame:
    """(row, links): each row's weak parts whose complements are near."""
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("p.kind") + 1)
    each = parts.select("_row", F.explode("_parts").alias("p")).select("_row", "p.*", role.alias("role"))
    covered = F.explode(F.sequence(F.floor(F.col("start") / REACH), F.floor(F.col("end") / REACH)))
    bins = each.where("role != 'endpoint'").withColumn("bin", covered).groupBy("_row", "scope", "role", "bin").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    weak = each.where(F.col("kind") >= BASE_KINDS)
    reach = weak.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - REACH) / REACH), F.floor((F.col("end") + REACH) / REACH))))
    near = (
        reach.alias("w").join(bins.alias("b"), ["_row", "scope", "bin"])
        .where((F.col("b.low") <= F.col("w.end") + REACH) & (F.col("b.high") >= F.col("w.start") - REACH) & (F.col("w.role") != F.col("b.role")))
        .groupBy("_row", "kind", "start", "end", F.col("w.role").alias("role"))
        .agg(F.count(F.when(F.col("b.role") == "identifier", 1)).alias("ids"), F.count(F.when(F.col("b.role") == "secret", 1)).alias("secrets"))
    )
    whole = near.where("(role = 'secret' and ids > 0) or (role = 'identifier' and secrets > 0) or (ids > 0 and secrets > 0)")
    return whole.groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_links"))


def scan_secrets(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of every row, with ``secrets``: an array of (start, kind, end),
    kind as a place in KINDS, by start, then kind.

    Null and empty texts have none. Rows stand alone: repeated rows and null ids are scanned like any.
    A column named ``secrets`` is replaced. ``keep`` is written once, with the parts found.
    """
    keep = [c for c in (keep or docs.columns) if c != "secrets"]
    found = stage(docs.withColumn("_parts", _parts(F.col("text"))).withColumn("_row", F.monotonically_increasing_id()).select("_row", "_parts", *keep), "secret-parts")
    links = _linked(found.select("_row", "_parts").where(F.exists("_parts", lambda p: p["kind"] >= BASE_KINDS)))
    strong = F.transform(F.filter("_parts", lambda p: p["kind"] < BASE_KINDS), lambda p: F.struct(p["start"], p["kind"], p["end"]))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    secrets = F.array_sort(F.concat(strong, F.coalesce(F.col("_links"), none)))
    return found.join(links, "_row", "left").select(*keep, secrets.alias("secrets"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    scanned = scan_secrets(docs.select("doc_id", "text"), ["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"] < BASE_KINDS)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    return scanned.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE_KINDS])],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by MASK; overlapping secrets share one mask."""
    text, columns = F.col("text"), docs.columns

    def put(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap, F.lit(MASK)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    finish = lambda acc: F.array_join(F.array_append(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))), "")
    masked = F.when(F.size("secrets") > 0, F.aggregate("secrets", start, put, finish)).otherwise(text)
    scanned = scan_secrets(docs.select(*[c for c in columns]), columns)
    return scanned.withColumn("text", masked).select(*columns)
