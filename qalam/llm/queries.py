"""The registered queries ``opN_<name>``: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalam.llm.compression_quality import compression_quality
from qalam.llm.exact_dedup import exact_dedup
from qalam.llm.license_scan import license_scan
from qalam.llm.line_dedup import line_dedup
from qalam.llm.near_dedup import near_dedup
from qalam.llm.packing import pack
from qalam.llm.periodic_runs import periodic_runs, run_lines, with_repeated_tails
from qalam.llm.piece_codec import decode_pieces, encode_pieces
from qalam.llm.quality_rules import quality_rules
from qalam.llm.spelling_groups import spelling_groups, vocabulary
from qalam.llm.tables import read_table
from qalam.llm.token_records import token_records
from qalam.llm.toxicity import toxicity
from qalam.llm.url_trust import url_filter
from qalam.session import scratch_path, ship_package

#: The tokenizer of packing and of token records; its place is a parameter of the operators.
WORD_TOKENIZER = "word_bpe_49k.json"

#: The SentencePiece model of the codec.
PIECE_MODEL = "piece_bpe_32k.model"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan(read_table(spark, sf_dir, "documents"))
    return scanned.withColumn("n_detections", F.size("detections").cast("long")).drop("detections")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = public_tokenizers.path(PIECE_MODEL)
    encoded = encode_pieces(read_table(spark, sf_dir, "documents"), model)
    digests = encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.element_at("ends", -1).cast("long").alias("n_bytes"),
        "ids",
    )
    decoded = decode_pieces(digests, model)
    return decoded.withColumn("decoded_sha256", F.sha2("text", 256)).drop("text")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pieces = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), end_id=2)
    return pieces.drop("ids")


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = scratch_path(spark, "records")
    records = token_records(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), end_id=1)
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read_table(spark, sf_dir, "pages"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_dedup(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup(read_table(spark, sf_dir, "documents"))
    return cleaned.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(vocabulary(read_table(spark, sf_dir, "documents"), drop_every=31))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = periodic_runs(with_repeated_tails(read_table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op13_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return compression_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_piece_codec": op4_piece_codec,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_token_records": op7_token_records,
    "op8_url_trust": op8_url_trust,
    "op9_near_dedup": op9_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_groups": op11_spelling_groups,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_compression_quality": op13_compression_quality,
}
