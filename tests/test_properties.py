"""Property-based checks (hypothesis) on small random inputs."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata_engine.operators import quality, scale, split

from test_scale_strata_split import _brute_force_split

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

strata_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(min_value=0, max_value=10**9)),
    min_size=1, max_size=120, unique_by=lambda t: t[1],
)


@SETTINGS
@given(rows=strata_rows, target=st.sampled_from([1, 3, 1000]),
       weights=st.sampled_from([(0.6, 0.2, 0.2), (0.8, 0.1, 0.1), (0.5, 0.25, 0.25)]))
def test_stratified_split_property(spark, rows, target, weights):
    df = spark.createDataFrame(rows, "s string, k long")
    got = {r.k: r.split for r in split.stratified_split(df, "s", ["k"], weights, target_rows=target).collect()}
    assert got == _brute_force_split(pd.DataFrame(rows, columns=["s", "k"]), "s", "k", weights)
    # disjoint and complete; every arm within one row of its target share
    by = pd.DataFrame([(s, got[k]) for s, k in rows], columns=["s", "split"])
    for _, g in by.groupby("s", dropna=False):
        n = len(g)
        for arm, w in zip(("train", "validation", "test"), weights):
            assert abs((g["split"] == arm).sum() - w * n) <= 1.0 + 1e-9


@SETTINGS
@given(xs=st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=2, max_size=60))
def test_scaling_properties(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    out = scale.scale(df, ["x"], ("min_max", "z_score")).toPandas()
    n, z = out["x_normalized"], out["x_standardized"]
    if max(xs) == min(xs):
        assert set(n) == {0.5} and set(z) == {0.0}
        return
    assert n.min() == 0.0 and abs(n.max() - 1.0) < 1e-12
    if z.std(ddof=1) > 0 and math.isfinite(z.std(ddof=1)):
        assert abs(z.mean()) < 1e-6 and abs(z.std(ddof=1) - 1.0) < 1e-6


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(min_value=-20, max_value=20)), min_size=1, max_size=50))
def test_rule_report_properties(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    rules = {"pos": "x > 0", "small": "x < 10", "sentinel": "x >= 0 OR x = -9"}
    rep = quality.report(df, rules).collect()
    assert all(r.n_passed + r.n_failed == r.n_total == len(vals) for r in rep)
    kept = quality.enforce(df, rules)
    assert all(r.n_failed == 0 for r in quality.report(kept, rules).collect())
    expected = sum(1 for v in vals if v is not None and v > 0 and v < 10)
    assert kept.count() == expected
