"""Model jobs: quantile baselines, and on MLlib the soft-voting classifier
ensemble, model comparisons and pipelines (quantile gradient boosting is in
``quantile_boost``).

Training data never leaves the cluster; only model parameters (trees,
per-leaf values bounded by 2^depth, thresholds) are held on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.selection import quantiles
from kestrel.session import shared_path

PART_ROWS = 1 << 15     # rows that a task of a fit has at least


# -- baselines ---------------------------------------------------------------
def quantile_baseline(df: DataFrame, y: str, segment: Sequence[str], parent: Sequence[str],
                      probs=(0.5, 0.8, 0.9), min_rows: int = 5) -> DataFrame:
    """Exact quantiles per segment, falling back to the parent group's when
    the segment has fewer than ``min_rows`` rows."""
    names = [f"p{int(round(p * 100))}" for p in probs]
    seg = quantiles(df, y, probs, [f"_s_{n}" for n in names], segment)
    par = quantiles(df, y, probs, [f"_p_{n}" for n in names], parent).drop("n")
    use = F.col("n") >= min_rows
    cols = [F.round(F.when(use, F.col(f"_s_{n}")).otherwise(F.col(f"_p_{n}")), 6).alias(n) for n in names]
    return seg.join(par, list(parent)).select(
        *segment, "n", *cols, F.when(use, "segment").otherwise(parent[0]).alias("level"))


def shadow_compare(old: DataFrame, new: DataFrame, key: str, score: str, threshold: float) -> DataFrame:
    j = old.select(key, F.col(score).alias("old_s")).join(new.select(key, F.col(score).alias("new_s")), key)
    a_old, a_new = F.col("old_s") >= threshold, F.col("new_s") >= threshold
    return j.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((a_old == a_new).cast("int")), 6).alias("agreement"),
                 F.round(F.avg(F.abs(F.col("old_s") - F.col("new_s"))), 6).alias("mean_abs_gap"),
                 F.count_if(a_old & a_new).alias("n_both"), F.count_if(a_old & ~a_new).alias("n_only_old"),
                 F.count_if(~a_old & a_new).alias("n_only_new"))


# -- classifiers / regressors ---------------------------------------------
def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.  Fits and scoring
    go over their rows several times and would repeat the joins behind them.
    A fit takes long for few bytes, so the rows are spread over all cores
    where file sizes would use fewer."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    back = spark.read.parquet(path)
    parts = min(3 * spark.sparkContext.defaultParallelism, back.count() // PART_ROWS)
    return back.repartition(parts) if parts > back.rdd.getNumPartitions() else back


def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def fit_soft_vote(train: DataFrame, label: str = "label", weight: str | None = "weight",
                  n_trees: int = 30, seed: int = 42, forest: int | None = None):
    """Two tree ensembles with different growth strategies (boosted trees
    and a random forest), class-weighted; the ensemble score is the mean of
    their positive-class probabilities."""
    kw = {"weightCol": weight} if weight else {}
    gbt = (GBTClassifier(labelCol=label, featuresCol="features", maxIter=n_trees, maxDepth=6, stepSize=0.1,
                         seed=seed, **kw)
           .setPredictionCol("_p1").setProbabilityCol("_prob1").setRawPredictionCol("_raw1").fit(train))
    rf = (RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=forest or n_trees, maxDepth=8, seed=seed, **kw)
          .setPredictionCol("_p2").setProbabilityCol("_prob2").setRawPredictionCol("_raw2").fit(train))
    return gbt, rf


def soft_vote_score(models, df: DataFrame) -> DataFrame:
    gbt, rf = models
    s = rf.transform(gbt.transform(df))
    return s.withColumns({"p_gbt": positive_probability("_prob1"), "p_rf": positive_probability("_prob2")}) \
        .withColumn("score", (F.col("p_gbt") + F.col("p_rf")) / 2) \
        .drop("_p1", "_prob1", "_raw1", "_p2", "_prob2", "_raw2")


def classifiers(label: str, seed: int = 42, n_trees: int = 20, forest: int | None = None, weight: str | None = None):
    kw = {"weightCol": weight} if weight else {}
    return {
        "logistic": LogisticRegression(labelCol=label, maxIter=1000, **kw),
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=forest or n_trees, maxDepth=6, seed=seed, **kw),
        "boosted_trees": GBTClassifier(labelCol=label, maxIter=n_trees, maxDepth=4, seed=seed, **kw),
    }


def regressors(label: str, seed: int = 42, n_trees: int = 20, forest: int | None = None):
    return {
        "ridge": LinearRegression(labelCol=label, regParam=1.0, elasticNetParam=0.0),
        "random_forest": RandomForestRegressor(labelCol=label, numTrees=forest or n_trees, maxDepth=6, seed=seed),
        "boosted_trees": GBTRegressor(labelCol=label, maxIter=n_trees, maxDepth=4, seed=seed),
    }


def fit_pipeline(train: DataFrame, feature_cols: Sequence[str], label: str, n_trees: int = 20,
                 seed: int = 42) -> PipelineModel:
    stages = [VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep"),
              GBTClassifier(labelCol=label, maxIter=n_trees, maxDepth=4, seed=seed)]
    return Pipeline(stages=stages).fit(train)
