"""Shared by the test modules: paths and column evaluation."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"


def one(spark, values, schema, expr):
    """Evaluate a column expression over literal rows, in order."""
    df = spark.createDataFrame([(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)],
                               "__i long, " + schema)
    return [r[0] for r in df.orderBy("__i").select(expr).collect()]
