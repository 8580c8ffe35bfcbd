"""Logarithmic buckets: error bound, merging, weights, signs."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paygrain.llm import sketch as K

PS = {"p10": 0.1, "mediane": 0.5, "p99": 0.99}


def exact(v, w, p):
    pairs = sorted(zip(v, w))
    total, c = sum(w), 0.0
    for x, y in pairs:
        c += y
        if c >= total * (p - 1e-12):
            return x


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e9, 1e9).map(lambda x: round(x, 3)), st.integers(0, 5)), min_size=1, max_size=60))
def test_error_bound(spark, pairs):
    d = spark.createDataFrame([(1, x, float(w)) for x, w in pairs], "g int, v double, w double")
    s = K.build(d, ["g"], "v", "w")
    for weighted in (False, True):
        r = K.percentiles(s, ["g"], PS, weighted=weighted).first()
        w = [b for _, b in pairs] if weighted else [1] * len(pairs)
        for n, p in PS.items():
            if sum(w) == 0:
                assert r[n] is None
            else:
                e = exact([a for a, _ in pairs], w, p)
                assert math.isclose(r[n], e, rel_tol=K.ERROR * 1.0001, abs_tol=1e-9)


def test_merge_equals_whole(spark, rows):
    random.seed(1)
    d = spark.createDataFrame([(random.randrange(3), random.lognormvariate(12, 1), random.random()) for _ in range(500)], "g int, v double, w double").withColumn("day", F.pmod(F.monotonically_increasing_id(), F.lit(4))).cache()
    parts = K.merge(K.build(d.where("day < 2"), ["g"], "v"), K.build(d.where("day >= 2"), ["g"], "v"))
    assert rows(parts) == rows(K.build(d, ["g"], "v"))
    both = K.both(K.build(d, ["g"], "v", "w"), ["g"], PS)
    assert rows(both, "g", *PS) == rows(K.percentiles(K.build(d, ["g"], "v"), ["g"], PS), "g", *PS)


def test_null_nan_infinite_zero_and_bad_weights(spark):
    d = spark.createDataFrame([(None, None, 1.0), (None, float("nan"), 1.0), (None, float("inf"), 1.0), (None, 0.0, None), (None, 5.0, -1.0), (None, 5.0, float("nan"))], "g int, v double, w double")
    r = K.percentiles(K.build(d, ["g"], "v", "w"), ["g"], {"a": 0.2, "z": 1.0}).first()
    assert (r.g, r.n, r.weight, r.a) == (None, 3, 0.0, 0.0) and abs(r.z - 5) < 0.03


def test_empty(spark):
    d = spark.createDataFrame([], "g int, v double")
    assert K.percentiles(K.build(d, ["g"], "v"), ["g"], PS).collect() == []
