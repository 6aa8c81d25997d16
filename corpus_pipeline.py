"""A training corpus from ``documents``: quality, near-duplicates, secrets, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. ``run`` writes each
stage's rows to the shared folder and reads them back for the next.

Rows may have further columns of any name: those a stage doesn't read pass through it under names that no
operator uses, and come out unchanged. An empty table gives an empty table of the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import mixing, pieces, quality_qda, secrets, simhash
from martloom.llm.common import staged_with_row, table
from martloom.session import stage

# Larger blocks than the query's, so that few documents are cut at the ends of a source's run.
MIX_BLOCK_WORDS = 256


READ = ("doc_id", "text", "source")


def _inner(docs: DataFrame) -> list[str]:
    """Each column's name inside a stage."""
    return [c if c in READ else f"passed__{i}" for i, c in enumerate(docs.columns)]


def _aside(docs: DataFrame) -> DataFrame:
    return docs.toDF(*_inner(docs))


def _back(out: DataFrame, docs: DataFrame, changed: bool = False) -> DataFrame:
    """The columns of ``docs`` again; ``n_chars`` follows a text that was changed."""

    def value(name: str, inner: str) -> Column:
        kept = F.length("text").cast("bigint") if changed and name == "n_chars" else F.col(inner)
        return kept.alias(name)

    return out.select(*[value(name, inner) for name, inner in zip(docs.columns, _inner(docs))])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Its labels are those of ``labels``.

    Null and empty texts are scored like any, by statistics of zero; a null id has no label; repeated rows
    have the same score, so all stay or all go."""
    scored = quality_qda.classify(_aside(docs), table(spark, sf_dir, "labels"))
    return _back(scored.where("predicted = 1"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked within 3 bits (three-word shingles) the document with the smallest id
    stays; of rows that repeat it, one. Texts without words are one group; a null id stays only where a group
    has no other."""
    rows = staged_with_row(_aside(docs), "near-docs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    marked = simhash.near_duplicates(rows.select(place.alias("doc_id"), "text"))
    first = marked.where("doc_id = component_id").select(F.col("doc_id.row").alias("_row"))
    return _back(rows.join(first, "_row", "left_semi"), docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are masked; ``n_chars`` follows the text. Every row stays; null and empty texts
    hold no secrets, and repeated rows are masked alike."""
    return _back(secrets.redact(_aside(docs)), docs, changed=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights: documents repeat, stay, go, or are cut at a run's end.

    Texts without words take no part in a mix and go. A null source is a source. Rows that tie in the seeded order
    (the same id and size) take what lies at their places, in any order."""
    sized = mixing.measured(_aside(docs))
    targets = mixing.source_targets(sized.select("source", "size"))
    return _back(mixing.mixed_texts(mixing.mix(sized, targets, MIX_BLOCK_WORDS, scatter=False), _inner(docs)), docs, changed=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding restores it. One row per row; null and empty texts
    have no ids. Only doc_id and text are read."""
    return pieces.encoding_report(docs, pieces.read_pieces(pieces.default_model()))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", hide_secrets),
    ("mixing sources", mixture),
    ("SentencePiece encoding", tokens),
]

# Fingerprints, a fitted classifier and piece ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
