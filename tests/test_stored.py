"""Training rows are prepared once."""

from pyspark.sql import functions as F



def test_stored_rows_are_read_by_many_tasks(spark, views):
    """The rows and vectors that were written, without the joins behind them."""
    from kestrel.modeling.models import assemble, stored
    d = assemble(spark.range(0, 400_000, 1, 1).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")), ["a", "b"])
    back = stored(d, "rows")
    assert back.schema["features"].dataType == d.schema["features"].dataType
    assert not back.exceptAll(d).count() and back.count() == 400_000
    assert back.rdd.getNumPartitions() == 12 and stored(d.limit(9), 'few').rdd.getNumPartitions() == 1
    from kestrel.plans import modeling
    frame = modeling._fraud_training(views)[0]
    assert "orders.parquet" not in " ".join(frame.inputFiles())
