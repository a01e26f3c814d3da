import math

from pyspark.sql import functions as F

from gridseries.functions.metrics import all_metrics


def _m(spark, yt, yp):
    df = spark.createDataFrame(list(zip(map(float, yt), map(float, yp))), "y_true double, y_pred double")
    return df.agg(*all_metrics(F.col("y_true"), F.col("y_pred"))).first()


def test_mae(spark):
    assert math.isclose(_m(spark, [1, 2, 3], [1, 2, 4]).MAE, 1 / 3)


def test_rmse(spark):
    assert math.isclose(_m(spark, [1, 1, 1], [1, 1, 4]).RMSE, math.sqrt(3))


def test_mape_finite_at_zero(spark):
    v = _m(spark, [0, 0, 1], [0.1, 0.2, 1]).MAPE_percent
    assert math.isfinite(v) and v > 0


def test_smape_symmetric_and_null_when_all_zero(spark):
    assert math.isclose(_m(spark, [1, 2], [2, 1]).sMAPE_percent, _m(spark, [2, 1], [1, 2]).sMAPE_percent)
    assert _m(spark, [0, 0], [0, 0]).sMAPE_percent is None


def test_four_metric_columns(spark):
    r = _m(spark, [1, 2], [1, 3])
    assert {"MAE", "RMSE", "MAPE_percent", "sMAPE_percent"} <= set(r.asDict())
