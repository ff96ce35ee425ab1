"""One-pass moments, pair correlations, quantiles and tail probabilities against numpy and plain formulas."""

import math

import numpy as np
import pytest

from tickerloom.operators import moments, profile, quantiles


def table(spark, rows=400, columns=6, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(rows, columns)) @ draw.normal(size=(columns, columns))
    x[:, 1] += 1e7
    x[:, 2] = 0.1
    x[:, 3] = np.where(draw.random(rows) < 0.4, np.nan, x[:, 3])
    x[:, 4] = np.round(x[:, 4])
    x[: rows // 2, 5] = np.nan
    names = [f"c{i}" for i in range(columns)]
    data = [[None if math.isnan(v) else float(v) for v in row] for row in x]
    return spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(7), x, names


def test_pair_correlations(spark):
    df, x, names = table(spark)
    got = {(r["left"], r["right"]): r["correlation"] for r in moments.correlations(df, names, names).collect()}
    assert len(got) == len(names) ** 2
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if 2 in (i, j):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_column_moments(spark):
    df, x, names = table(spark)
    rows = {r["column"]: r for r in moments.column_moments(df.selectExpr("*", "'t' AS word", "CASE WHEN c0 > 0 THEN 'infinity'::double END AS far"), [*names, "word", "far"]).collect()}
    for i, name in enumerate(names):
        own = x[~np.isnan(x[:, i]), i]
        r = rows[name]
        assert (r["rows"], r["count"]) == (len(x), len(own))
        assert r["mean"] == pytest.approx(own.mean(), rel=1e-12) and r["std"] == pytest.approx(own.std(ddof=1), rel=1e-8, abs=1e-15)
        assert (r["min"], r["max"]) == (own.min(), own.max())
    assert rows["word"]["count"] == len(x) and rows["word"]["mean"] is None
    assert rows["far"]["infinite_count"] == (x[:, 0] > 0).sum() and rows["far"]["max"] == math.inf
    none = moments.column_moments(df.limit(0), names).collect()
    assert len(none) == len(names) and all(r["rows"] == 0 and r["mean"] is None and r["std"] is None for r in none)


def test_400_columns_are_one_scan(spark, tmp_path):
    columns = [f"c{i}" for i in range(400)]
    wide = spark.range(500).selectExpr(*[f"CAST((id * {i + 3}) % 97 AS double) AS {c}" for i, c in enumerate(columns)])
    wide.write.parquet(f"{tmp_path}/wide")
    stored = spark.read.parquet(f"{tmp_path}/wide")
    for df in (profile.null_census(stored), profile.correlated_pairs(stored, columns), profile.feature_metadata(stored)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1
    census = profile.null_census(stored).collect()
    assert len(census) == 400 and all(r["missing_count"] == 0 for r in census)
    pairs = profile.correlated_pairs(stored, columns, 0.999).collect()
    assert all(r["feature1"] != r["feature2"] for r in pairs) and len({frozenset((r[0], r[1])) for r in pairs}) == len(pairs)
    # Columns whose factors agree modulo 97 are equal.
    assert {("c0", "c97"), ("c1", "c98")} <= {(r["feature1"], r["feature2"]) for r in pairs}


@pytest.mark.parametrize("rows,accuracy", [(1, 10000), (2, 10000), (3, 50), (10, 10000), (997, 40), (997, 10000)])
def test_quantiles_of_ties_and_small_tables(spark, rows, accuracy):
    draw = np.random.default_rng(rows)
    data = [(f"g{k % 3}", float(draw.normal()), float(draw.integers(0, 4)), None if k % 2 else float(k)) for k in range(rows)]
    df = spark.createDataFrame(data, "g string, x double, y double, z double").repartition(4)
    shares = {"low": 0.01, "q25": 0.25, "q50": 0.5, "q95": 0.95, "top": 1.0}
    for by in ([], ["g"]):
        found = quantiles.exact_quantiles(df, ["x", "y", "z"], shares, by, accuracy).collect()
        seen = set()
        for r in found:
            own = [d["xyz".index(r["column"]) + 1] for d in data if not by or d[0] == r["g"]]
            own = [v for v in own if v is not None]
            seen.add((r["column"], r["g"] if by else None))
            for name, share in shares.items():
                assert r[name] == pytest.approx(np.quantile(own, share), abs=1e-12)
        assert seen == {(c, d[0] if by else None) for d in data for k, c in enumerate("xyz") if d[k + 1] is not None}


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    row = profile.describe(df, ["x"]).first()
    assert row["count"] == 0 and row["mean"] is None and row["q50"] is None
    assert profile.describe(df.limit(0), ["x"]).first()["count"] == 0


def test_student_tail_for_any_freedom():
    # Closed forms for one and two degrees of freedom, the normal tail for very many.
    for t in (0.0, 0.3, 1.0, 4.0, 50.0):
        assert profile.student_two_sided(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, abs=1e-13)
        assert profile.student_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-13)
        for freedom in (1e6, 9e7, 1.1e8, 1e14):
            assert profile.student_two_sided(t, freedom) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=2e-4, abs=1e-9)
    below, above = (profile.student_two_sided(1.96, f) for f in (0.999e8, 1.001e8))
    assert below == pytest.approx(above, rel=1e-7)
