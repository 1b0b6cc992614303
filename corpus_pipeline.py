"""The training-data pipeline: documents that pass each stage go on to the next.

Each stage gets all that its predecessor kept, and its decisions take effect:

* quality: documents whose perplexity is over their language's threshold go;
* exact_dedup: of equal texts the row with the largest doc_id stays;
* near_dedup: of each group of near copies the row with the smallest doc_id stays;
* mix: a document appears as often as the mix takes it (0 to 2 times);
* encode: token ids of each document, with the digests of ids and decoded text.

All but the last return the columns of ``documents``. Stages decide by doc_id: rows
that share one (or have none) stay if any of them does; rows repeated in doc_id
and text are one row after exact_dedup; where rows of one doc_id are taken
differently by the mix, the larger number holds. Extra columns are passed on.
Empty tables give empty results.

``run`` writes each stage's result in the shared folder and reads it back, so a
lost executor costs no more than the stage that runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.llm import exact_dedup, mixing, near_dedup, pieces, quality
from cellar.llm._common import read_table, written
from cellar.llm.queries import tokenizer_path

#: Decisions (a doc_id and a number each) that are looked up by broadcast at most; more are joined by shuffle.
BROADCAST_IDS = 2_000_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _looked_up(table: DataFrame) -> DataFrame:
    """A written table of decisions, to be broadcast if it is small."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _unused(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keep(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is kept in ``decisions`` (doc_id, kept)."""
    name = _unused(docs, "kept_id")
    ids = written(decisions.filter("kept").select(F.col("doc_id").alias(name)).distinct(), "kept")
    return docs.join(_looked_up(ids), docs["doc_id"].cast("long").eqNullSafe(F.col(name)), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _keep(docs, quality.classify(docs, read_table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decisions = written(exact_dedup.exact_duplicates(docs), "exact")
    out = _keep(docs, decisions)
    repeated = decisions.filter("kept").groupBy("doc_id", "text_sha256").count().filter("count > 1")
    return out if repeated.isEmpty() else out.dropDuplicates(["doc_id", "text"])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _keep(docs, near_dedup.near_duplicates(docs))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name, times = _unused(docs, "mixed_id"), _unused(docs, "mixed_times")
    taken = written(mixing.mix(docs).groupBy(F.col("doc_id").alias(name)).agg(F.max("copies").alias(times))
                    .filter(F.col(times) > 0), "taken")
    joined = docs.join(_looked_up(taken), docs["doc_id"].cast("long").eqNullSafe(F.col(name)))
    return joined.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(name, times)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, tokenizer_path(), keep_ids=True, keep_text=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

#: SQL can't express the trained classifier, the sampling or the encoding; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
