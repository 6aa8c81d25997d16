"""Merkle manifest of a table, and its versions after tampering, as a persistent tree with path copying.

Every row is a leaf; the leaves of a source in order form a tree of runs of three, and the sources' roots a tree of
the same kind. The tree is kept as tables of aligned blocks of 3^BLOCK_LEVELS neighbours, one group each:

* A block turns its nodes into their common ancestor, BLOCK_LEVELS levels up. The ancestors are the nodes of the next
  round, in blocks again, until every tree has one node. Rounds grow with the logarithm of the rows, and a node's shared
  path to the root (what stands left and right of it, level by level) is joined from the rounds, one row per block.
* A tampered leaf makes a version of the tree. It shares all nodes of the original but its ancestors: inside its block the
  ancestors alone are copied, with the siblings read from the shared levels; above the block the copy goes on as a fold over
  the block's shared path, in the row of the version. Versions stay dealt by their blocks, so a hot source is no hot task.

A node of no siblings above (the last run may hold one node) is hashed alone. Empty columns count as ``-``; rows of null ids
come first and are never tampered; a null source is a source. Rows of the same id are ordered by their digest, equal rows
in any order (they have the same digest, so the tree is the same). An empty table has no rows. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.keys import with_surrogate_key
from martloom.session import stage

FAN = 3
# A block holds FAN ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(text: Column, fields: tuple[str, ...] = FIELDS) -> Column:
    """Digest of a row's fields: of each its byte count, a colon and the value, or ``-`` for null."""
    values = [text if f == "text" else F.col(f).cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def height(nodes: Column) -> Column:
    """Levels from ``nodes`` nodes to one: the number of powers of FAN below it."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k).cast("bigint") for k in range(40)]), lambda p: p < nodes))


def levels_of(digests: list[str], steps: int) -> list[list[str]]:
    """The block's nodes and, level by level, their ancestors."""
    levels = [digests]
    for _ in range(steps):
        below = levels[-1]
        levels.append([_digest(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return levels


def path_of(levels: list[list[str]], i: int) -> Iterator[tuple[str, str]]:
    """What stands left and right of node i and of its ancestors in their runs, joined, level by level."""
    for level in levels[:-1]:
        first = i - i % FAN
        yield "".join(level[first:i]), "".join(level[i + 1 : first + FAN])
        i //= FAN


def _steps(group: pd.DataFrame) -> int:
    return min(BLOCK_LEVELS, int(group["levels"].iloc[0]))


def _ancestor(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    digests = group.sort_values("idx")["digest"].tolist()
    top = levels_of(digests, _steps(group))[-1][0]
    return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "levels": [int(group["levels"].iloc[0]) - _steps(group)], "digest": [top]})


def _paths(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("idx")
    levels = levels_of(group["digest"].tolist(), _steps(group))
    paths = [list(path_of(levels, i)) for i in range(len(group))]
    return pd.DataFrame(
        {"tree": key[0], "up": key[1], "idx": group["idx"], "left": [[a for a, _ in p] for p in paths], "right": [[b for _, b in p] for p in paths]}
    )


NODE = "tree bigint, idx bigint, levels int, digest string"
PATH = "tree bigint, up bigint, idx bigint, left array<string>, right array<string>"


def _block(idx: str = "idx") -> Column:
    return F.expr(f"{idx} div {FAN**BLOCK_LEVELS}")


def ancestors(nodes: DataFrame) -> DataFrame:
    """One row per block of ``nodes`` (tree, idx, levels still to go, digest): the block's common ancestor."""
    return nodes.groupBy("tree", _block().alias("block")).applyInPandas(_ancestor, NODE)


def paths_to_root(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(tree, idx, left, right) for every node: its whole path; and (tree, root) for every tree."""
    rounds = []
    now = stage(nodes, f"{name}-nodes")
    while True:
        most = now.agg(F.max("levels")).first()[0]
        if not most:
            break
        rounds.append(stage(now.groupBy("tree", _block().alias("block")).applyInPandas(_paths, PATH), f"{name}-paths"))
        now = stage(ancestors(now), f"{name}-nodes")
    roots = now.select("tree", F.col("digest").alias("root"))
    none = F.array().cast("array<string>")
    above = now.select("tree", "idx", none.alias("left"), none.alias("right"))
    for below in reversed(rounds):
        upper = above.select("tree", F.col("idx").alias("up"), F.col("left").alias("_left"), F.col("right").alias("_right"))
        joined = below.join(upper, ["tree", "up"])
        above = stage(joined.select("tree", "idx", F.concat("left", "_left").alias("left"), F.concat("right", "_right").alias("right")), f"{name}-above")
    return above, roots


def _versions(key: tuple, leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Of each leaf of a block the proof, and the nodes of its version (of itself, if not tampered) up to the block's ancestor."""
    leaves = leaves.sort_values("idx")
    levels = levels_of(leaves["digest"].tolist(), _steps(leaves))
    over = "".join(a + b for a, b in zip(above["left"].iloc[0], above["right"].iloc[0]))
    proofs, copies = [], []
    for i, tampered in enumerate(leaves["tampered"]):
        path = list(path_of(levels, i))
        proofs.append(_digest(*(part for sides in path for part in sides), over))
        copy = [tampered or levels[0][i]]
        for left, right in path:
            copy.append(_digest(left, copy[-1], right))
        copies.append(copy)
    return pd.DataFrame(
        {
            "tree": key[0], "idx": leaves["idx"], "doc_id": leaves["doc_id"], "leaf": leaves["digest"], "tampered": leaves["tampered"].notna(),
            "proof_sha256": proofs, "path": copies, "left": [above["left"].iloc[0]] * len(leaves), "right": [above["right"].iloc[0]] * len(leaves),
        }
    )


# doc_id is text on its way through pandas, where a null would turn a block's ids into floats.
VERSION = "tree bigint, idx bigint, doc_id string, leaf string, tampered boolean, proof_sha256 string, path array<string>, left array<string>, right array<string>"


def fold(start: Column, left: str, right: str) -> Column:
    """``start`` (an array of digests) and, appended, the digests of its last node's ancestors along a path."""
    sides = F.arrays_zip(F.col(left).alias("l"), F.col(right).alias("r"))
    return F.aggregate(sides, start, lambda done, s: F.concat(done, F.array(F.sha2(F.concat(s.l, F.element_at(done, -1), s.r), 256))))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, source, digest, tampered digest (null where the row isn't tampered) and the leaf's place in its source.

    ``tampered`` is the text after tampering; null where nothing is done to the row."""
    fields = docs.select(F.col("doc_id").cast("bigint"), "source", "lang", F.col("n_chars").cast("bigint"), "text")
    done = F.when(tampered.isNotNull(), leaf_digest(tampered))
    rows = fields.select("doc_id", "source", leaf_digest(F.col("text")).alias("digest"), done.alias("tampered"), F.monotonically_increasing_id().alias("_row"))
    return with_surrogate_key(rows, ["source", "doc_id", "digest", "_row"], "_at", start=0).drop("_row")


def versions(docs: DataFrame, tampered: Column) -> DataFrame:
    """One row per row of ``docs``: place (source, idx), leaf, tampered, subroot, root, proof_sha256 and path.

    ``path`` lists the digests from the leaf to the root, folded anew from the leaf as it is now and its siblings: of a tampered
    row the nodes that its version copies (all others are shared), else those of the original tree."""
    placed = leaves(docs, tampered)
    counted = stage(placed.groupBy("source").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")), "merkle-sources")
    sources = with_surrogate_key(counted, ["source"], "tree", start=0).withColumnRenamed("source", "_source")
    rows = placed.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    idx, todo = (F.col("_at") - F.col("_first")).alias("idx"), height(F.col("_rows")).alias("levels")
    nodes = stage(rows.select("tree", F.col("doc_id").cast("string"), idx, todo, "digest", "tampered"), "merkle-leaves")
    in_source, subroots = paths_to_root(ancestors(nodes.select("tree", "idx", "levels", "digest")), "merkle-source")
    subroots = stage(subroots, "merkle-subroots")
    trees = subroots.count()
    tops = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), height(F.lit(trees).cast("bigint")).alias("levels"), F.col("root").alias("digest"))
    over_source, root = paths_to_root(tops, "merkle-top")
    over = over_source.select(F.col("idx").alias("tree"), F.col("left").alias("_left"), F.col("right").alias("_right"))
    above = in_source.join(over, "tree").select("tree", F.col("idx").alias("block"), F.concat("left", "_left").alias("left"), F.concat("right", "_right").alias("right"))
    blocks = nodes.withColumn("block", _block())
    out = blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInPandas(_versions, VERSION)
    out = out.withColumns({"path": fold(F.col("path"), "left", "right"), "doc_id": F.col("doc_id").cast("bigint")}).drop("left", "right")
    named = subroots.withColumnRenamed("root", "subroot").join(sources.select("tree", F.col("_source").alias("source")), "tree")
    top = root.select("root").first()
    return out.join(named, "tree").withColumn("root", F.lit(top["root"] if top else None).cast("string"))


def without_line_ends() -> Column:
    """The trial's tampering: every second document by checksum loses its line ends."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even & F.col("text").isNotNull(), F.replace("text", F.lit("\n"), F.lit("")))


def manifest_report(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every row, and the root that a verifier folds from the row as it is now."""
    made = versions(docs, without_line_ends())
    out = made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", F.element_at("path", -1).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
