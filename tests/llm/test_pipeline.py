"""The pipeline's stages on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import queries, simhash

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, SF_DIR), "stage")
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    quality, near, masked, mixed, tokens = kept.values()
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 0").collect()}
    assert not bad & {r["doc_id"] for r in quality}
    prints = {simhash.fingerprint(r["text"]) for r in quality}
    assert len(near) <= len(prints) and {r["doc_id"] for r in near} <= {r["doc_id"] for r in quality}
    assert {r["doc_id"] for r in masked} == {r["doc_id"] for r in near} and not any("AKIA" in r["text"] for r in masked)
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in masked} and len(tokens) == len(mixed)
    assert all(r["restored"] for r in tokens)


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))


# Every name that an operator of a stage uses inside, and those of its results.
CLASHES = [
    "stats", "score", "predicted", "held_out", "label", "_row", "fp", "component_id", "none", "id", "row", "_parts", "_links", "secrets", "size", "source_size",
    "target", "taken", "_order", "_bucket", "_key", "_before", "_first", "_lo", "_passes", "_from", "_rest", "_blocks", "_seats", "_within", "_take", "_null", "_place", "weight",
]


def rows_of(spark):
    texts = [None, "", "  ", "a plain text of some ten words that says very little", "token=abcdef123456 user=bob at example.com", "word " * 400, "one two", "One  two"]
    rows = [(i, texts[i % len(texts)], "ab"[i % 2] if i % 3 else None, i) for i in range(24)] + [(None, "no id here", "a", 1), (3, texts[3], "a", 3), (3, texts[3], "a", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES[:-1])
def test_columns_of_clashing_names_pass_unchanged(spark, name, step):
    plain = rows_of(spark)
    extra = plain.withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce("doc_id", F.lit(-1))) for c in CLASHES})
    out = step(spark, extra, SF_DIR)
    assert out.columns == extra.columns
    rows = out.collect()
    assert all(r[c] == f"{c}:{-1 if r['doc_id'] is None else r['doc_id']}" for r in rows for c in CLASHES)
    wanted = step(spark, plain, SF_DIR).collect()
    assert sorted(repr(tuple(r)[:4]) for r in rows) == sorted(repr(tuple(r)) for r in wanted)
    assert all(r["n_chars"] == len(r["text"] or "") for r in wanted if r["text"] and name in ("secret scans", "mixing sources"))
    assert step(spark, extra.limit(0), SF_DIR).collect() == []


def test_last_stage_reads_ids_and_texts_only(spark):
    plain = rows_of(spark)
    extra = plain.withColumns({c: F.lit("x") for c in ("ids", "decoded", "n_ids", "word", "uses", "restored")})
    out = corpus_pipeline.tokens(spark, extra, SF_DIR)
    assert out.columns == ["doc_id", "n_ids", "ids", "restored"] and all(r["restored"] for r in out.collect())
    assert out.count() == plain.count() and corpus_pipeline.tokens(spark, extra.limit(0), SF_DIR).collect() == []


def test_one_document_of_each_group_of_fingerprints_stays(spark, make):
    """Against linking all pairs of fingerprints within 3 bits."""
    base = [f"w{i % 61}" for i in range(300)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k:]]) for k in range(0, 300, 7)] + ["", None, "one two", "One  two"] + [" ".join(f"y{i}{j}" for j in range(30)) for i in range(10)]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "alone"), (100, texts[0])]
    prints = [simhash.fingerprint(t) & (2**64 - 1) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, p in enumerate(prints):
            group[i] = min(group[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3)
    least = {}
    for (doc, _), g in zip(rows, group):
        least[g] = min(least.get(g, (True, 0)), (doc is None, doc or 0))
    kept = corpus_pipeline.near_duplicates(spark, make("doc_id long, text string", rows), "").collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0) for r in kept)) == sorted(least.values())
