"""Approximate nearest neighbours (largest inner product) on robust-pruned directed graphs.

Distinct vectors are dealt over shards by length, a band for each power of two; each shard is one graph. Vectors
get one more component that makes all of a shard the same length, so the largest inner product is the smallest
distance and the pruning rule holds; in a band no vector is so much longer that the others fall together. A graph is grown in batches: a greedy beam search for each vector proposes neighbours, robust
pruning keeps those that no kept neighbour is closer to by the factor ALPHA, and links back are pruned
alike. A query walks every shard's graph with a beam; the best of all shards are merged.

Equal vectors share one node with their smallest ids, as many as can appear in a result, so a vector that
holds a third of all rows is one node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.session import stage

NEAREST = 20
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 64
QUERY_BEAM = 128
WIDTH = 4  # nodes opened at once
BATCH = 512
ENTRIES = 16
SHARD_VECTORS = 8192  # a shard with its graph must fit one task
QUERY_BLOCK = 4096


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length 1 at most and given a component that makes it 1. Squares are of vectors whose
    largest component is 1, so they don't overflow."""
    scaled = vectors / np.abs(vectors).max()
    squares = (scaled * scaled).sum(axis=1)
    top = squares.max()
    return np.hstack([scaled / np.sqrt(top), np.sqrt(np.maximum(0, 1 - squares / top))[:, None]])


def length_band(vector: Column) -> Column:
    """The power of two nearest to the length: lengths about 1 are in one band."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + (x / largest) * (x / largest))
    return F.floor(F.log2(largest) + F.log2(squares) / 2 + 0.5).cast("int")


def _distances(points: np.ndarray, at: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Squared distance of points[at[i, j]] and targets[i], less |targets[i]|²; all points have length 1."""
    return 1.0 - 2.0 * np.einsum("ijd,id->ij", points[at], targets, optimize=True)


def beam_search(points: np.ndarray, graph: np.ndarray, entries: np.ndarray, targets: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``beam`` nearest nodes met for every target; -1 where there are fewer."""
    rows, n = len(targets), len(points)
    seen = np.zeros((rows, n + 1), dtype=bool)  # the last column stands for "no node"
    seen[:, n] = True
    ids = np.full((rows, beam), n, dtype=np.int64)
    far = np.full((rows, beam), np.inf)
    opened = np.ones((rows, beam), dtype=bool)
    line = np.arange(rows)[:, None]

    def take(fresh: np.ndarray) -> None:
        nonlocal ids, far, opened
        fresh = np.sort(fresh, axis=1)
        new = ~seen[line, fresh]
        new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        seen[line, fresh] = True
        distance = np.where(new, _distances(points, np.minimum(fresh, n - 1), targets), np.inf)
        ids, far = np.hstack([ids, np.where(new, fresh, n)]), np.hstack([far, distance])
        opened = np.hstack([opened, ~new])
        best = np.argsort(far, axis=1, kind="stable")[:, :beam]
        ids, far, opened = ids[line, best], far[line, best], opened[line, best]

    take(np.broadcast_to(entries, (rows, len(entries))).copy())
    links = np.vstack([graph, np.full((1, graph.shape[1]), n)])
    links = np.where(links < 0, n, links)
    while not opened.all():
        first = np.argsort(opened, axis=1, kind="stable")[:, :WIDTH]  # the nearest that aren't open yet
        nodes = np.where(opened[line, first], n, ids[line, first])
        opened[line, first] = True
        take(links[nodes].reshape(rows, -1))
    return np.where(ids == n, -1, ids), far


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node ``own[i]``, up to ``degree`` of its candidates (-1: none), nearest first; a kept one
    removes those that are ``alpha`` times closer to it than to the node."""
    candidates = np.sort(candidates, axis=1)
    void = (candidates < 0) | (candidates == own[:, None])
    void[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
    others = points[np.maximum(candidates, 0)]
    far = np.where(void, np.inf, 2.0 - 2.0 * np.einsum("ijd,id->ij", others, points[own], optimize=True))
    out = np.full((len(own), degree), -1, dtype=np.int64)
    line = np.arange(len(own))
    alive = far.copy()
    for k in range(degree):
        pick = np.argmin(alive, axis=1)
        some = np.isfinite(alive[line, pick])
        if not some.any():
            break
        out[some, k] = candidates[line, pick][some]
        between = 2.0 - 2.0 * np.einsum("ijd,id->ij", others, others[line, pick], optimize=True)
        alive[alpha * alpha * between <= far] = np.inf
        alive[line, pick] = np.inf
    return out


def build_graph(points: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour lists (-1: none) and entry nodes."""
    n = len(points)
    rng = np.random.default_rng(seed)
    centre = int(np.argmax(points @ points.mean(axis=0)))
    entries = np.unique(np.append(rng.choice(n, size=min(n, ENTRIES - 1), replace=False), centre))
    graph = np.full((n, DEGREE), -1, dtype=np.int64)
    graph[:, : DEGREE // 4] = rng.integers(0, n, size=(n, DEGREE // 4))
    for alpha, beam in ((1.0, BUILD_BEAM // 2), (ALPHA, BUILD_BEAM)):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            own = order[at : at + BATCH]
            met, _ = beam_search(points, graph, entries, points[own], beam)
            graph[own] = robust_prune(points, own, np.hstack([met, graph[own]]), DEGREE, alpha)
            _link_back(points, graph, own, alpha)
    return graph, entries


def _link_back(points: np.ndarray, graph: np.ndarray, own: np.ndarray, alpha: float) -> None:
    """Every neighbour of ``own`` gets the link back; lists that grow over the degree are pruned."""
    n, degree = graph.shape
    to, source = graph[own].ravel(), np.repeat(own, degree)
    to, source = to[to >= 0], source[to >= 0]
    nodes = np.unique(to)
    if not len(nodes):
        return
    known = graph[nodes]
    pairs = np.sort(np.concatenate([to * n + source, (nodes[:, None] * n + known)[known >= 0]]))
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    counts = np.bincount(np.searchsorted(nodes, pairs // n), minlength=len(nodes))
    order = np.argsort(counts, kind="stable")  # lists of like length are pruned together
    starts = np.cumsum(counts) - counts
    fits = order[counts[order] <= degree]
    long = order[len(fits) :]

    def lists(some: np.ndarray, width: int) -> np.ndarray:
        at = np.arange(width)
        inside = at < counts[some, None]
        return np.where(inside, pairs[np.minimum(starts[some, None] + at, len(pairs) - 1)] % n, -1)

    graph[nodes[fits]] = lists(fits, degree)
    for at in range(0, len(long), BATCH):
        some = long[at : at + BATCH]
        graph[nodes[some]] = robust_prune(points, nodes[some], lists(some, counts[some[-1]]), degree, alpha)


GRAPH = "dim int, shard int, vectors binary, graph binary, entries binary, ids binary, starts binary"


def _build(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("hash", kind="stable")
    vectors = np.stack(nodes["vector"].to_numpy()).astype(np.float64)
    graph, entries = build_graph(lengthened(vectors))
    ids = [np.sort(np.asarray(x, dtype=np.int64)) for x in nodes["ids"]]
    starts = np.cumsum([0, *map(len, ids)])
    row = [*map(int, key), vectors.tobytes(), graph.astype(np.int32).tobytes(), entries.astype(np.int64).tobytes(), np.concatenate(ids).tobytes(), starts.astype(np.int64).tobytes()]
    return pd.DataFrame([row], columns=[c.split()[0] for c in GRAPH.split(", ")])


def build_index(vectors: DataFrame, k: int = NEAREST, shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """One row per shard: its distinct vectors, graph, entries and ids.

    ``vectors``: (vec_id, vector), usable ones only. Of equal vectors the k + 1 smallest ids are kept:
    they tie, ties go to smaller ids, and a query drops at most its own.
    """
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    kept = vectors.withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= k + 1)
    nodes = stage(kept.groupBy("vector").agg(F.collect_list("vec_id").alias("ids")).withColumns({"hash": F.xxhash64("vector"), "band": length_band(F.col("vector"))}), "graph-nodes")
    counts = nodes.groupBy("band").count().orderBy("band").collect()  # at most some 2,000 bands of doubles
    shards, first_of = 0, []
    for r in counts:
        of_band = -(-r["count"] // shard_vectors)
        first_of.append((r["band"], shards, of_band))
        shards += of_band
    plan = nodes.sparkSession.createDataFrame(first_of, "band int, first int, of_band int")
    shard = (F.col("first") + F.pmod("hash", F.col("of_band"))).cast("int")
    dealt = nodes.join(F.broadcast(plan), "band").withColumns({"dim": F.size("vector"), "shard": shard}).drop("band", "first", "of_band")
    shards = max(1, shards)
    # One task a shard: by default small shuffle partitions, thus whole shards, would be put together.
    apart = dealt.repartitionByRange(shards, "dim", "shard")
    return stage(apart.groupBy("dim", "shard").applyInPandas(_build, GRAPH), "graph-shards")


def _search(k: int):
    def search(key: tuple, shards: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        for shard in shards.itertuples():
            if not len(queries):
                break
            vectors = np.frombuffer(shard.vectors, dtype=np.float64).reshape(-1, shard.dim)
            graph = np.frombuffer(shard.graph, dtype=np.int32).reshape(len(vectors), -1).astype(np.int64)
            entries, ids, starts = (np.frombuffer(x, dtype=np.int64) for x in (shard.entries, shard.ids, shard.starts))
            points = lengthened(vectors)
            asked = np.stack(queries["vector"].to_numpy()).astype(np.float64)
            for at in range(0, len(asked), BATCH):
                some = asked[at : at + BATCH]
                scaled = some / np.abs(some).max(axis=1)[:, None]
                unit = scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]
                targets = np.hstack([unit, np.zeros((len(some), 1))])
                met, _ = beam_search(points, graph, entries, targets, max(QUERY_BEAM, 2 * k))
                for query, q, nodes in zip(queries["query_id"].iloc[at : at + BATCH], some, met):
                    nodes = nodes[nodes >= 0]
                    score = (vectors[nodes] * q).sum(axis=1)  # exact, in double precision
                    best = np.argsort(-score, kind="stable")
                    if len(best) > k + 1:  # ties with the last one stay: they are settled by id
                        best = best[score[best] >= score[best[k]]]
                    found = np.concatenate([ids[starts[j] : starts[j + 1]] for j in nodes[best]])
                    scores = np.repeat(score[best], [starts[j + 1] - starts[j] for j in nodes[best]])
                    first = np.lexsort((found, -scores))[: k + 1]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": found[first], "score": scores[first]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return search


def nearest(index: DataFrame, queries: DataFrame, k: int = NEAREST, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates found, its own id aside.

    ``queries``: (query_id, vector), usable ones, distinct. Queries go to every shard of their length, in
    blocks of about ``query_block``, so a task holds one graph and one block.
    """
    blocks = max(1, -(-queries.count() // query_block))
    shards = index.agg(F.max("shard")).first()[0]
    if shards is None:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = queries.select("query_id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(int(shards)))))
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    by = ["dim", "shard", "block"]
    tasks = 2 * blocks * (int(shards) + 1)
    found = graphs.repartition(tasks, *by).groupBy(*by).cogroup(asked.repartition(tasks, *by).groupBy(*by)).applyInPandas(_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.where("query_id != vec_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_table(embeddings: DataFrame, every: int = 20, k: int = NEAREST, **sizes) -> DataFrame:
    """Rows whose vec_id ``every`` divides, against all rows of ``embeddings`` (vec_id, embedding).

    Null, zero and non-finite vectors and null ids take no part; repeated rows of an id and vector are one
    row; vectors of another length than the query's are not its candidates. Fewer than k candidates
    give fewer rows; an empty table none.
    """
    named = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = stage(named.where(usable(F.col("vector")) & F.col("vec_id").isNotNull()).distinct(), "graph-rows")
    index = build_index(rows, k, sizes.get("shard_vectors", SHARD_VECTORS))
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    return nearest(index, queries, k, sizes.get("query_block", QUERY_BLOCK))
