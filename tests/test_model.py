import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.operators import forest as M
from odolake.operators.alerting import top_features
from odolake.operators.quantile import exact_quantile

AT = "2026-06-07 12:00:00"


@pytest.fixture(scope="module")
def gold(spark):
    """600 rows spread around common values and 12 with far too fast a discharge."""
    h = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / F.lit(1000.0) for i in range(5)]
    odd = F.when(F.col("id") >= 600, 1.0).otherwise(0.0)
    return spark.range(612).select(
        F.format_string("VF-%03d", "id").alias("vehicle_id"), F.to_timestamp(F.lit(AT)).alias("window_start"),
        (70 + 10 * h[0]).alias("avg_battery_pct"), (350 + 10 * h[1]).alias("avg_voltage_v"),
        (90 + 10 * h[2]).alias("avg_current_a"), (45 + 5 * h[3] + odd * 40).alias("avg_motor_temp_c"),
        (0.4 + 0.1 * h[4] + odd).alias("rolling_5min_discharge_rate"), F.to_timestamp(F.lit(AT)).alias("aggregated_at"),
    )


def test_average_path_length():
    assert list(M.average_path(np.array([0, 1, 2]))) == [0.0, 0.0, 1.0]
    want = 2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256
    assert float(M.average_path(256)) == pytest.approx(want)


def test_forest_properties(gold):
    f = M.fit_forest(gold, AT, trees=60)
    assert f.sample_size == 256 and f.trained_rows == 612
    assert f.nodes["tree"].nunique() == 60 and f.nodes["depth"].max() <= 8
    leaves = f.nodes[f.nodes["feature"] < 0]
    assert (leaves.groupby("tree")["size"].sum() == 256).all()
    scored = M.score(gold, f).toPandas()
    normality = scored["anomaly_score"] + f.offset
    assert ((normality > -1) & (normality < 0)).all()
    assert scored["is_anomaly"].mean() == pytest.approx(S.CONTAMINATION, abs=0.01)
    worst = set(scored.nsmallest(12, "anomaly_score")["vehicle_id"])
    assert worst == {f"VF-{i:03d}" for i in range(600, 612)}


def test_forest_does_not_depend_on_partitions(gold):
    a = M.fit_forest(gold, AT, trees=10)
    b = M.fit_forest(gold.repartition(13), AT, trees=10)
    order = ["tree", "node"]
    x, y = (f.nodes.sort_values(order).reset_index(drop=True) for f in (a, b))
    assert (x[["feature", "left", "right", "size"]] == y[["feature", "left", "right", "size"]]).all().all()
    assert np.allclose(x["threshold"], y["threshold"]) and a.offset == pytest.approx(b.offset)
    assert not M.fit_forest(gold, AT, trees=10, seed=99).nodes["threshold"].equals(a.nodes["threshold"])


def test_too_few_rows_and_nulls(gold):
    assert M.fit_forest(gold.limit(9), AT) is None
    assert M.fit_forest(gold.limit(20).withColumn("avg_voltage_v", F.lit(None).cast("double")), AT) is None
    f = M.fit_forest(gold, AT, trees=5)
    assert M.score(gold.limit(1).withColumn("avg_voltage_v", F.lit(None).cast("double")), f).first().anomaly_score is not None


def test_old_rows_are_not_trained_on(gold):
    assert M.fit_forest(gold, "2026-08-07 12:00:00") is None


@pytest.mark.parametrize("q", [0.0, 0.05, 0.31, 0.5, 0.999, 1.0])
def test_exact_quantile(spark, q):
    values = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7.0).alias("x"))
    want = float(np.percentile(values.toPandas()["x"], 100 * q))
    assert exact_quantile(values, "x", q, bins=8, enough=5) == pytest.approx(want, abs=1e-12)
    assert exact_quantile(values.where("x < 0"), "x", q) is None


def test_top_features(gold):
    rows = {r.vehicle_id: r.top_features for r in top_features(gold).collect()}
    assert rows["VF-605"][:2] == ["rolling_5min_discharge_rate", "avg_motor_temp_c"]
    same = gold.limit(3).select("vehicle_id", "window_start", "aggregated_at", *[F.lit(0.0).alias(f) for f in S.FEATURES])
    assert top_features(same).first().top_features == list(S.FEATURES[:3])
