"""The queries op1 to op13: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, covertree, jaccard, langid, lexical, licenses, packing, periods, pieces, planes, quality, shards, vectors
from parley.llm.common import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]
_CATALOG: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _CATALOG[function.__name__] = function
    return function


def catalog() -> dict[str, Query]:
    return dict(_CATALOG)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark)
    planes.write_ids(table(spark, folder, "documents"), target, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return planes.read_documents(spark, target)


@_query
def op4_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard(table(spark, folder, "documents"), 16)


@_query
def op7_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=0, capacity=2048)


@_query
def op6_stream_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


def fold(divisor: int) -> Column:
    """The remainder of the checksum of ``doc_id`` as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


@_query
def op3_kneser_ney_languages(spark: SparkSession, folder: str) -> DataFrame:
    found = langid.identify(table(spark, folder, "documents"), fold(3) != 1)
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected", "entropy", "symbols")


@_query
def op10_fourier_quality(spark: SparkSession, folder: str) -> DataFrame:
    # one of the three learning folds calibrates
    scored = quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"), fold(4) != 2, fold(4) == 3)
    held_out = F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


@_query
def op2_parity_sketch_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"), words=4, part=85, whole=100)


@_query
def op8_itq_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"), threshold=0.9)


@_query
def op9_dual_tree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10, factor=1024.0)


@_query
def op5_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@_query
def op11_dual_tree_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts, of which those whose hash of the id ends in 0 repeat a stretch from a word on."""
    planted = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed = F.floor(planted / 10)

    def repeated(words: Column) -> Column:
        start = seed % F.size(words)
        rest = F.size(words) - start
        period = F.lit(1) + F.floor(rest / (F.lit(3) + seed % 8))
        stretch = F.slice(words, (start + 1).cast("int"), period.cast("int"))
        tail = F.slice(F.flatten(F.array_repeat(stretch, F.ceil(rest / period).cast("int"))), F.lit(1), rest.cast("int"))
        return F.array_join(F.concat(F.slice(words, F.lit(1), start.cast("int")), tail), " ")

    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # a list of one, so that the words are made once
    text = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return docs.select("doc_id", F.when((planted % 10 == 0) & F.col("text").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@_query
def op12_scale_minimizers(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.runs_of(with_planted_runs(table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op13_piece_rounds(spark: SparkSession, folder: str) -> DataFrame:
    found = pieces.encode(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"), decoded=True)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
