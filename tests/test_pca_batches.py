"""PCA scores and rebuilt rows, a batch of rows at a time."""
from __future__ import annotations

import math

import numpy as np

from lumenframe.operators import linear


def test_matrix_times_keeps_nulls(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [3.0, float("nan")])], "id int, v array<double>")
    got = [r.s for r in df.withColumn("s", linear._matrix_times(np.array([[1.0, 1.0], [0.0, 2.0], [1.0, 0.0]]), before=np.array([1.0, 0.0]))("v")).orderBy("id").collect()]
    assert got[0] == [2.0, 4.0, 0.0] and got[1] == got[2] == [None] * 3
    assert math.isnan(got[3][0]) and math.isnan(got[3][1])


def test_no_expression_repeats_the_row_before_it(spark):
    """As expressions put into each other, the plan of a rebuilt row grew with the product of both matrices."""
    df = spark.createDataFrame([(0, [1.0, 2.0, 4.0]), (1, [0.0, 1.0, 1.0]), (2, [2.0, 2.0, 5.0])], "id int, v array<double>")
    model = linear.pca(df, "v", 3)
    out = model.reconstruct(model.scores(df, "v"), "scores")
    assert "zip_with" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert np.allclose([r.rebuilt for r in out.orderBy("id").collect()], [[1, 2, 4], [0, 1, 1], [2, 2, 5]])
