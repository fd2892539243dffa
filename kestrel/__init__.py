"""kestrel: Spark-first analytics operators and queries.

Functions of this package that run inside Python workers (``mapInPandas``,
``applyInPandas``, ``applyInPandasWithState``) are pickled by value, so
executors need no installed copy of the package.
"""

try:  # PySpark ships its own cloudpickle
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(__import__(__name__))
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
    pass
