"""From documents to packed sequences: language, quality, near duplicates, packing.

Each stage takes what its predecessor kept and writes it to the shared folder; all but the last
return the columns of ``documents``. A stage decides per row of its input, so rows that share a
``doc_id`` are judged together only where they are equal.

Stages:
- ``language``: drops texts that language identification rejects (no letters, or far from every
  language of the input).
- ``quality``: drops texts whose chance of label 1 is below ``LEAST_QUALITY``.
- ``near_duplicates``: of each group linked by five-word shingles at 0.8 the document of the
  smallest ``doc_id`` stays; documents without words are in no group.
- ``packing``: sequences of at most 2048 tokens.

Nulls and edges: a null or empty text has no letter and goes in the first stage; a null
``doc_id`` can be matched with no decision and goes there too; rows that share a ``doc_id`` go
together if any of them is to go, and the third stage keeps one row of them; an empty table gives no rows;
further columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import jaccard, langid, packing, quality
from parley.llm.common import id_filter, stored
from parley.llm.queries import fold, tokenizer_file

#: A text goes if the chance of label 1 is lower; short clean texts score lower than long ones.
LEAST_QUALITY = 0.3


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` is not in ``ids(doc_id)``, with the columns they came with.

    Most rows are surely not among them. Of the others, nearly all are, so only the ids of the
    few exceptions are looked up, and of the texts only theirs are shuffled.
    """
    perhaps, surely_not = id_filter(docs, ids)
    stay = stored(perhaps.select("doc_id").distinct().join(ids.select("doc_id").distinct(), "doc_id", "left_anti"))
    found = id_filter(docs, stay)[0]
    kept = stay.withColumnRenamed("doc_id", "_kept")
    return surely_not.union(found.join(kept, found["doc_id"] == kept["_kept"], "left_semi"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = docs.where("doc_id IS NOT NULL")
    found = langid.identify(known, fold(3) != 1)
    return _without(known, stored(found.where("rejected").select("doc_id")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, labels, fold(4) != 2, fold(4) == 3, LEAST_QUALITY)
    return _without(docs, stored(scored.where("predicted = 0").select("doc_id")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = stored(jaccard.near_duplicates(docs, words=5, part=80, whole=100))
    others = found.where("doc_id <> component_id").select("doc_id").distinct()
    # rows that share an id are one document, of which one row stays
    again = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated, single = id_filter(docs, stored(again))
    return _without(single.union(repeated.dropDuplicates(["doc_id"])), stored(others))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]

#: No stage but the third can be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of a folder, each written and read again but the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
