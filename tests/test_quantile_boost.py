"""Quantile boosting against a plain implementation on whole arrays."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from kestrel.modeling import quantile_boost as Q

ALPHAS = {"P50": 0.5, "P90": 0.9}


def data(n=900, seed=2):
    r = np.random.default_rng(seed)
    x = np.stack([r.integers(0, 12, n), r.integers(0, 2, n), r.integers(0, 30, n), np.full(n, 7)], axis=1).astype(float)
    return x, np.round(np.maximum(0, 8 * x[:, 0] + x[:, 2] * r.gamma(2, 2, n) - 20))


def frame(spark, x, y, parts=3):
    rows = [(v.tolist(), float(t)) for v, t in zip(x, y)] + [(x[0].tolist(), None)]
    return spark.createDataFrame(rows, "a array<double>, label double").repartition(parts).select(
        array_to_vector("a").alias("features"), "label")


def plain(x, y, alpha, rounds, depth, rate):
    """Greedy trees over all cuts between values, one row set at a time."""
    f, init = np.full(len(y), np.percentile(y, 100 * alpha)), np.percentile(y, 100 * alpha)
    for _ in range(rounds):
        g = np.where(y > f, alpha, alpha - 1)
        sets = [np.arange(len(y))]
        for _ in range(depth):
            out = []
            for rows in sets:
                best = (1e-9, None)
                for j in range(x.shape[1]):
                    for cut in np.unique(x[rows, j])[:-1] if len(rows) else []:
                        left = x[rows, j] <= cut
                        a, b = g[rows][left], g[rows][~left]
                        gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - g[rows].sum() ** 2 / len(rows)
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
                out += [rows, rows[:0]] if best[1] is None else [rows[best[1]], rows[~best[1]]]
            sets = out
        for rows in sets:
            if len(rows):
                f[rows] += rate * np.percentile((y - f)[rows], 100 * alpha)
    return init, f


@pytest.mark.parametrize("keep, cells", [(1 << 14, 1024), (20, 16)])
def test_against_plain_trees(spark, monkeypatch, keep, cells):
    """Also with residuals found over several narrowing passes."""
    monkeypatch.setattr(Q, "KEEP", keep)
    monkeypatch.setattr(Q, "CELLS", cells)
    monkeypatch.setattr(Q, "WRITE_EVERY", 2)
    x, y = data()
    models = Q.fit(frame(spark, x, y), ALPHAS, rounds=3, depth=3, learning_rate=0.3)
    for name, alpha in ALPHAS.items():
        init, want = plain(x, y, alpha, 3, 3, 0.3)
        assert models[name].init == pytest.approx(init)
        assert np.abs(models[name].predict(x) - want).max() < 1e-9


@pytest.mark.parametrize("task_most, block", [(1 << 20, 1 << 16), (900, 100), (899, 1 << 16)])
def test_a_task_a_model_and_a_job_a_pass_give_the_same(spark, monkeypatch, task_most, block):
    """One block of rows, several, and more rows than a task takes."""
    monkeypatch.setattr(Q, "TASK_MOST", task_most)
    monkeypatch.setattr(Q, "BLOCK_ROWS", block)
    x, y = data()
    models = Q.fit(frame(spark, x, y), ALPHAS, rounds=5, depth=3, learning_rate=0.3)
    for name, alpha in ALPHAS.items():
        init, want = plain(x, y, alpha, 5, 3, 0.3)
        assert models[name].init == pytest.approx(init)
        assert np.abs(models[name].predict(x) - want).max() < 1e-9


def with_jobs(spark, name, run):
    """What ``run`` gives and how many jobs it took."""
    spark.sparkContext.setJobGroup(name, "")
    try:
        out = run()
    finally:
        for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(k, None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_rounds(spark):
    """Ten rounds were over sixty jobs, 300 rounds 1 900."""
    x, y = data()
    jobs = {rounds: with_jobs(spark, f"boost-{rounds}", lambda r=rounds: Q.fit(
        frame(spark, x, y), ALPHAS, rounds=r, depth=2))[1] for rounds in (2, 40)}
    assert 0 < jobs[40] == jobs[2] < 20


def test_bundle_transform_and_importances(spark, tmp_path):
    x, y = data()
    models = Q.fit(frame(spark, x, y, 1), ALPHAS, rounds=4, depth=2)
    Q.save_bundle(spark, models, str(tmp_path / "b"))
    again = Q.load_bundle(spark, str(tmp_path / "b"))
    got = again["P90"].transform(frame(spark, x, y, 2).na.drop(), out="p").select("features", "p").collect()
    for r in got:
        assert r.p == models["P90"].predict(np.array([r.features.toArray()]))[0]
    shares = dict(again["P90"].importances(["a", "b", "c", "flat"]))
    assert sum(shares.values()) == pytest.approx(1) and shares["flat"] == 0 and shares["c"] > 0


@pytest.mark.parametrize("different", [Q.BINS - 1, Q.BINS, Q.BINS + 1, 400])
def test_many_different_values_fit_the_bins(spark, different):
    """Where all quantiles differ there is one cut too many."""
    n = 4 * different
    x = np.stack([np.arange(n) % different / 8, np.arange(n) % 2], axis=1).astype(float)
    df = frame(spark, x, x[:, 0] ** 2)
    edges = Q.bin_edges(df.select(vector_to_array("features").alias("_x")), 2)
    assert len(edges[0]) == min(different, Q.BINS) - 1 and len(edges[1]) == 1
    y = x[:, 0] ** 2
    model = Q.fit(df, ALPHAS, rounds=2, depth=3, learning_rate=1.0)["P50"]
    assert np.abs(model.predict(x) - y).mean() < 0.3 * np.abs(np.median(y) - y).mean()


def test_no_rows_and_one_value(spark):
    x, y = data(30)
    assert Q.fit(frame(spark, x, y).where("label IS NULL"), ALPHAS, rounds=2) == {}
    flat = Q.fit(frame(spark, x, np.full(30, 5.0)), ALPHAS, rounds=2, depth=2)
    assert (flat["P50"].predict(x) == 5.0).all()


def test_cells_cover_their_ends():
    r = np.random.default_rng(0)
    for _ in range(30):
        lo, hi = sorted(r.normal(size=2) * 10.0 ** r.integers(-5, 8))
        for cell in (0, 1, 500, Q.CELLS - 1):
            a, b = Q._cell_ends(lo, hi, cell)
            inside = np.array([a, a + (b - a) / 3, b])
            assert set(Q._cells(inside, lo, hi)) == {cell} and lo <= a <= b <= hi


def test_queries_share_one_trained_bundle(spark, views, monkeypatch):
    from kestrel.plans import modeling as m
    fitted, fit = [], m.fit_delay_quantiles

    def short(v, rounds=m.BOOST_ROUNDS):
        fitted.append(rounds)
        return fit(v, rounds=2)

    monkeypatch.setattr(m, "fit_delay_quantiles", short)
    monkeypatch.setattr(m, "_BUNDLES", {})
    top = m.ml_feature_importance(views).collect()
    logs = m.ml_batch_score(views).collect()
    assert fitted == [300] and 0 < len(top) <= 10
    assert len(logs) > 0 and all(r.prediction_P50 <= r.prediction_P90 for r in logs)
    assert set(m.DELAY_FEATURES) >= {"month_sin", "weather_code_75", "direction_id_1"}


def test_importance_of_all_rounds_in_few_jobs(spark, views, monkeypatch):
    """The training alone was 1 900 jobs."""
    from kestrel.plans import modeling as m
    monkeypatch.setattr(m, "_BUNDLES", {})
    top, jobs = with_jobs(spark, "importance", lambda: m.ml_feature_importance(views).collect())
    assert 0 < jobs < 300
    assert [r["rank"] for r in top] == list(range(1, 11))
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True) and top[0].importance > 0
    models = m.delay_models(views)
    assert {n: len(x.value) for n, x in models.items()} == dict.fromkeys(m.QUANTILES, m.BOOST_ROUNDS)
    assert all(len(v) == 2 ** m.BOOST_DEPTH for v in models["P90"].value)


def test_boost_query_of_all_rounds_in_few_jobs(spark, views, monkeypatch):
    """The training alone was 1 900 jobs."""
    from kestrel.plans import modeling as m
    monkeypatch.setattr(m, "_BUNDLES", {})
    rows, jobs = with_jobs(spark, "boost-query", lambda: m.ml_quantile_boost(views).collect())
    assert 0 < jobs < 400
    test = m.delay_training_frame(views).where("split = 'test'").select("id", "label", "features").collect()
    models, x = m.delay_models(views), np.array([r.features.toArray() for r in test])
    want = {r.id: (r.label, *p) for r, *p in zip(test, *(models[n].predict(x) for n in m.QUANTILES))}
    assert len(rows) == len(want) == len(test)
    for r in rows:
        assert (r.actual_delay, r.prediction_P50, r.prediction_P80, r.prediction_P90) == pytest.approx(want[r.id], abs=1e-6)
