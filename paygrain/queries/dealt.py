"""Queries of the data-quality operators p1 to p4 and p6, over whole tables, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fill, profile, schema_drift, snapshots, spikes
from ..session import table
from .dealt_sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible(table(spark, d, "declarations"))


def p1_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """Calendar-month effect and tail cutoff of every source."""
    r = spikes.SpikeRules()
    return spikes.tail_cutoffs(spikes.series(spikes.readings(table(spark, d, "declarations"), r), r), r)


def p1_flags(spark: SparkSession, d: str) -> DataFrame:
    """Every flagged value with its rule, residual and cutoff."""
    return spikes.flag_spikes(table(spark, d, "declarations"))


def p1_rules(spark: SparkSession, d: str) -> DataFrame:
    """The flags that don't come from fitted tails, with their rule."""
    return p1_flags(spark, d).where("regle <> 'tail'").select("ligne_id", "champ", "regle")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.schema_changes(table(spark, d, "lignes_brutes")).select("fichier", "champ", "changement")


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    """The one consistent table of all files; autres as text, in order."""
    t = schema_drift.unify(table(spark, d, "lignes_brutes"))
    pair = lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))
    return t.withColumn("autres", F.array_join(F.transform(F.array_sort(F.map_entries("autres")), pair), ";"))


def p3_changes(spark: SparkSession, d: str) -> DataFrame:
    """The changes with the names of the fields that differ, in the order of the alphabet."""
    c = _changes(spark, d)
    return c.withColumn("changed", F.array_join(F.array_sort("changed"), ","))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.snapshot_changes(
        table(spark, d, "instantanes"),
        "instantane",
        ("id_indiv", "numero_employeur", "period"),
        ("type_salarie", "csp_code", "commune", "secteur_activite_cod", "sexe"),
        ("salaire_brut", "duree_travaillee"),
        "ligne",
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d).select("instantane", "obs_id", "changement")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.drift(table(spark, d, "chargements"))


def p4_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.profile_loads(table(spark, d, "chargements"))


def p4_figures(spark: SparkSession, d: str) -> DataFrame:
    """The profile's figures without those of induced expressions."""
    return p4_profile(spark, d).drop("foreign", "main", "main_coverage")


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of every induced expression per load, against the agency's preceding load."""
    return profile.coverage(table(spark, d, "chargements"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    c = fill.filled_cells(table(spark, d, "base_analytique"), table(spark, d, "panel_employeur"))
    return c.select("nom_table", "ligne_id", "champ")


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    """The filled cells with their values."""
    return fill.filled_cells(table(spark, d, "base_analytique"), table(spark, d, "panel_employeur"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_cutoffs, p1_flags, p1_rules, p2_found, p2_table, p3_found, p3_changes, p4_found, p4_profile, p4_figures, p4_coverage, p6_found, p6_values)
}
