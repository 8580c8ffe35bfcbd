"""Queries of the operators p5 and p7 to p9, over whole tables and whole texts.

The percentiles have SQL twins (sql.py); of the others, the encoder is held against the vocabulary's own library, leak search against brute force, the
finder of personal information by held-out accuracy (tests/llm)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import bpe, leaks, pii, sketch
from .sql import GROUPS, ORACLE, PS

__all__ = ["ORACLE", "QUERIES"]


def _sketches(spark: SparkSession, d: str, dims: tuple[str, ...]) -> DataFrame:
    """Sketches of usable wages per month, for all and per further group."""
    base = table(spark, d, "base_analytique").where(F.col("salaire_brut_mens").between(0, 90_000_000))
    groups = F.array(
        F.struct(F.lit("ensemble").alias("dimension"), F.lit("Total").alias("groupe")),
        *[F.struct(F.lit(g).alias("dimension"), F.col(g).alias("groupe")) for g in dims],
    )
    # buckets are taken before the rows are multiplied by the groups
    b = base.select("annee", "mois", sketch.bucket_of(F.col("salaire_brut_mens")).alias("bucket"), "w_final", F.explode(groups).alias("_g"))
    w = F.coalesce(F.sum(F.when(F.col("w_final") >= 0, F.col("w_final").try_cast("decimal(14,6)"))), F.lit(0))
    return b.groupBy("annee", "mois", "_g.dimension", "_g.groupe", "bucket").agg(F.count("*").alias("n"), w.alias("weight"))


def _percentiles(s: DataFrame, month: str) -> DataFrame:
    out = sketch.both(s, ["annee", month, "dimension", "groupe"], PS)
    return out.select("annee", month, "dimension", "groupe", "n", "poids", *[F.round(c, 4).alias(c) for c in out.columns[6:]])


def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Plain and weighted percentiles of usable wages per month, for all and per further group."""
    return _percentiles(_sketches(spark, d, GROUPS), "mois")


def p5_quarters(spark: SparkSession, d: str) -> DataFrame:
    """The same per quarter, from the months' sketches alone."""
    s = _sketches(spark, d, GROUPS).withColumn("trimestre", F.ceil(F.col("mois") / 3).cast("int"))
    return _percentiles(sketch.roll_up(s, ["annee", "trimestre", "dimension", "groupe"]), "trimestre")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_texts(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "passages_test")).select("doc_id", "item_id")


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where in each text the leaked stretches stand, and how much of passage and text they make up."""
    return leaks.leak_spans(table(spark, d, "documents"), table(spark, d, "passages_test"))


def p8_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every text without the passages' stretches that are over the length or coverage limit."""
    return leaks.remove(table(spark, d, "documents"), table(spark, d, "passages_test"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.personal_information(table(spark, d, "documents"))


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every text with typed placeholders."""
    return pii.redact(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p5_percentiles, p5_quarters, p7_ids, p8_found, p8_spans, p8_cleaned, p9_found, p9_redacted)}
