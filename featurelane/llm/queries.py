"""The registered queries of the package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelane.llm import (attribution, binary_packing, chaining, compression, iblt, lexical, merkle, mixing, perspectives, ppm, pu_quality,
                             ship, sum_of_squares, vertical_join)
from featurelane.sources.tables import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents")


def op1_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, boundary-crossing tokens by majority of bytes."""
    return attribution.attribute_tokens(documents(spark, sf_dir))


def op2_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    plan = mixing.mix_plan(documents(spark, sf_dir))
    one = plan.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"),
                      F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_row"))
    return one.drop("_row")


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, compression ratios and verdict of every document."""
    return compression.compression_columns(documents(spark, sf_dir))


def op4_invertible_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's."""
    return iblt.compare_next(documents(spark, sf_dir))


def op5_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's power-of-two pieces."""
    pieces = binary_packing.pack_documents(documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def _remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def op6_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by shortest code length."""
    docs = documents(spark, sf_dir)
    found = ppm.identify(docs, _remainder("doc_id", 4) != 2)
    return found.select("doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the point of view of each participant."""
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs = documents(spark, sf_dir)
    scored = pu_quality.score(docs, table(spark, sf_dir, "labels"), _remainder("doc_id", 3) != 1)
    return scored.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_vertical_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of n-gram Jaccard links."""
    return vertical_join.VerticalJoin(documents(spark, sf_dir)).components()


def op10_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that an earlier document holds too."""
    return chaining.passages(documents(spark, sf_dir))


def op11_blocked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item's ten best documents."""
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in the packed sequences."""
    pieces = sum_of_squares.encode_pieces(documents(spark, sf_dir))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return sum_of_squares.pack_pieces(digests)


def op13_sibling_shift_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and folded root; in every seventh by the remainder, n_chars is read as one more."""
    found = merkle.manifest(documents(spark, sf_dir), altered={"n_chars": F.col("n_chars").cast("long") + 1}, where=_remainder("doc_id", 7) == 0)
    return found.drop("path")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_attribution, op2_pivotal_mixing, op3_compression_bands, op4_invertible_sketch, op5_binary_packing,
                            op6_ppm_language, op7_perspective_rotation, op8_pu_quality, op9_vertical_join, op10_collinear_chaining,
                            op11_blocked_search, op12_sum_of_squares, op13_sibling_shift_manifest)
}
#: The others are not SQL and are tested against brute force, round trips or held-out accuracy.
ORACLE: dict[str, str] = {"op7_perspective_rotation": perspectives.ORACLE, "op11_blocked_search": lexical.ORACLE,
                          "op13_sibling_shift_manifest": merkle.ORACLE}
