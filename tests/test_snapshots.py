"""Changes between snapshots: tolerance, blanks, missing keys, repeated keys, gaps in numbering."""

from pyspark.sql import functions as F

from paygrain.operators.snapshots import snapshot_changes

SCHEMA = "instantane int, ligne bigint, a string, b string, t string, x double"


def changes(spark, rows, extra=None):
    d = spark.createDataFrame(rows, SCHEMA)
    d = d.withColumns(extra) if extra else d
    return sorted((r.instantane, r.obs_id, r.changement, r.changed) for r in snapshot_changes(d, "instantane", ("a", "b"), ("t",), ("x",), "ligne").collect())


def test_added_removed_changed_and_noise(spark):
    rows = [
        (1, 1, "p", "q", "v", 1.0), (1, 2, "r", "q", " v ", 2.0), (1, 3, "s", "q", "", 3.0), (1, 4, "u", "q", "v", None),
        (2, 5, " p ", "q", "v ", 1.005), (2, 6, "s", "q", None, 3.0051), (2, 7, "u", "q", "v", float("nan")), (2, 8, "n", "q", "v", 1.0),
    ]
    assert changes(spark, rows) == [(2, "n_q", "added", None), (2, "r_q", "removed", None), (2, "s_q", "changed", ["x"])]


def test_repeated_key_highest_line_holds_and_missing_id(spark):
    rows = [(1, 1, None, "q", "v", 1.0), (1, 2, "", "q", "w", 1.0), (2, 3, "  ", "q", "w", 1.0), (2, 9, "k", "q", "b", 1.0), (2, 8, "k", "q", "a", 1.0), (3, 10, "k", "q", "b", 1.0), (3, 11, None, "q", "w", 1.0)]
    assert changes(spark, rows) == [(2, "k_q", "added", None)]


def test_numbers_with_gaps_compare_neighbours(spark):
    rows = [(1, 1, "p", "q", "v", 1.0), (4, 2, "p", "q", "w", 1.0)]
    assert changes(spark, rows) == [(4, "p_q", "changed", ["t"])]


def test_null_equals_null_only(spark):
    rows = [(1, 1, "p", "q", None, None), (2, 2, "p", "q", None, 1.0)]
    assert changes(spark, rows) == [(2, "p_q", "changed", ["x"])]


def test_empty_one_snapshot_and_clashing_columns(spark):
    assert changes(spark, []) == []
    assert changes(spark, [(1, 1, "p", "q", "v", 1.0)]) == []
    extra = {c: F.lit(1) for c in ("_s", "obs_id", "_r", "_n", "changement")}
    assert changes(spark, [(1, 1, "p", "q", "v", 1.0), (2, 2, "p", "q", "w", 1.0)], extra) == [(2, "p_q", "changed", ["t"])]
