"""Registered queries take every row of their tables."""

import pytest

from paygrain.functions.similarity import jaro
from paygrain.queries import reference as R

PARTS = [(1, "almond azure", "Brand#11"), (2, "blush chiffon", "Brand#23"), (3, "cornsilk dim", "Brand#11"), (4, "zzz", "Brand#45"), (7, "forest ghost", "Brand#11"), (8, "azure almond", "Brand#52")]


@pytest.fixture
def parts(spark, tmp_path):
    spark.createDataFrame(PARTS, "p_partkey bigint, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def best(name):
    """Brute force over the whole lookup; prepared texts are lower case with punctuation as blanks."""
    scores = [(jaro(name, f"{b[::-1]} {n}".lower().replace("#", " ")), f"{b[::-1]} {n}") for _, n, b in PARTS]
    top = max(s for s, _ in scores)
    return min(m for s, m in scores if s == top) if top >= 0.7 else None, round(top, 6)


def test_every_part_is_a_lookup_row(spark, parts, rows):
    assert rows(R.joi05b_win11_best_matches(spark, parts)) == sorted((n, *best(n)) for _, n, _ in PARTS)
    assert rows(R.joi05_fuzzy_join(spark, parts)) == sorted((k, *best(n)) for k, n, _ in PARTS)
    assert {m for _, m, _ in rows(R.joi05b_win11_best_matches(spark, parts))} > {"11#dnarB almond azure", "32#dnarB blush chiffon"}


def test_match_quality_counts_every_part(spark, parts):
    got = {r.quality: (r.n, r.mean_score) for r in R.agg25_match_quality(spark, parts).collect()}
    want = {}
    for _, n, _ in PARTS:
        s = best(n)[1]
        want.setdefault("excellent" if s >= 0.95 else "good" if s >= 0.85 else "acceptable" if s >= 0.75 else "poor" if s >= 0.6 else "rejected", []).append(s)
    assert got == {q: (len(s), pytest.approx(sum(s) / len(s), abs=2e-6)) for q, s in want.items()}


def test_every_customer_is_compared(spark, tmp_path, rows):
    spark.createDataFrame([(1, "FRANCE", 3)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(3, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    names = [f"Customer#{k:09d}" for k in range(11)]
    spark.createDataFrame(list(enumerate(names)), "c_custkey bigint, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    want = sorted([("FRANCE", "EUROPEFRANCE"), *((n, n.replace("0", "O")) for n in names)])
    for q in (R.str04_to_str07_similarities, R.str06_str07_more_similarities):
        got = q(spark, str(tmp_path))
        assert rows(got, "a", "b") == want and got.dropna().count() == len(want)
