"""Correlations per group in one pass: nulls, constant columns, no multiplied rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import aggregates as agg


def test_matrix_with_nulls_and_constants(spark):
    r = np.random.default_rng(1)
    a = r.normal(size=400)
    cols = {"a": a, "b": a * 2 + r.normal(size=400), "c": np.full(400, 3.0), "d": r.normal(size=400)}
    rows = [tuple(None if name == "d" and i % 5 == 0 else float(v[i]) for name, v in cols.items()) + (i % 2,)
            for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, g int").repartition(5)
    got = {(x.var_a, x.var_b): x for x in agg.corr_matrix(df, ["a", "b", "c", "d"], F.col("g")).collect()}
    assert len(got) == 16
    for (p, q), x in got.items():
        for g, value in ((0, x.corr_without), (1, x.corr_with)):
            if "c" in (p, q):
                assert value is None
                continue
            use = [i for i in range(400) if i % 2 == g and not ("d" in (p, q) and i % 5 == 0)]
            assert value == pytest.approx(np.corrcoef(cols[p][use], cols[q][use])[0, 1], abs=1e-6)
    plan = agg.corr_matrix(df, ["a", "b"], F.col("g"))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate"):]
    assert "Generate" not in below      # rows are counted as they are
    few = agg.corr_with_target(df, ["a", "d"], "b", F.col("g")).collect()
    assert {x.feature: x.corr_with for x in few} == {f: got[f, "b"].corr_with for f in ("a", "d")}
