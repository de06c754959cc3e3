"""No row is lost: unknown features, NULL keys, the last walk-forward block, permutations."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecast.operators import models as mo
from tidecast.operators import validation as va

DAY0 = dt.datetime(2020, 1, 1)


def frame(spark, n=40, series=("a", None)):
    rows = [(s, DAY0 + dt.timedelta(days=i), i, None if i == 3 else float(i), float(2 * i + 1)) for s in series for i in range(n)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, i long, x double, y double")


def test_rows_with_unknown_features_are_kept_without_prediction(spark):
    d = frame(spark)
    out = mo.linear_forecast(d, ["x"], "y").transform(d).select("series", "i", "yhat").collect()
    assert len(out) == 80
    assert all((r["yhat"] is None) == (r["i"] == 3) for r in out)
    assert all(abs(r["yhat"] - (2 * r["i"] + 1)) < 1e-9 for r in out if r["i"] != 3)


def test_permutation_moves_each_row_once_over_the_whole_series(spark):
    d = frame(spark, n=300)
    for task_rows in (7, 100_000):
        out = mo.permuted(d, ["y"], task_rows=task_rows).select("series", "i", "y", F.col("_perm.y").alias("p")).collect()
        assert len(out) == 600
        for s in ("a", None):
            mine = sorted((r["i"], r["y"], r["p"]) for r in out if r["series"] == s)
            assert sorted(p for _, _, p in mine) == [y for _, y, _ in mine]
            assert max(abs(p - y) for _, y, p in mine) > 300  # far over 7 rows
        if task_rows == 7:
            first = sorted(map(str, out))
    assert sorted(map(str, out)) == first


def test_every_step_after_the_first_range_is_tested_once(spark):
    d = frame(spark).select("series", "ts").unionByName(spark.createDataFrame([("a", None)], "series string, ts timestamp_ntz"))
    spec = va.WalkForward(initial=10, test=7, gap=2)
    ranges = va.fold_ranges(d, spec).collect()
    assert len(ranges) == 81
    for r in ranges:
        t = r["t"]
        assert (r["test_fold"] is None) == (t is None or t < 12)
        if t is None:
            assert r["train_from"] is None
    roles = va.walk_forward(d, spec).where("role = 'test'").groupBy("series", "ts").count().collect()
    assert len(roles) == 2 * 28 and all(r["count"] == 1 for r in roles)


def test_labels_known_in_the_test_block_are_purged_on_gappy_series(spark):
    d = frame(spark, series=("a", "b")).where("series = 'a' or i % 6 = 0")
    nxt = F.lead("ts").over(Window.partitionBy("series").orderBy("ts"))
    d = va.with_steps(d.withColumn("label_ts", nxt))
    seen = []

    def fit_predict(train, test, k):
        seen.append((train.agg(F.max("label_ts")).first()[0], test.agg(F.min("ts")).first()[0]))
        return test.select("series", "ts")
    n = va.walk_forward_run(d, va.WalkForward(initial=13, test=5, gap=1), fit_predict, label_ts="label_ts").count()
    assert n == d.where("t >= 14").count()
    assert len(seen) == 6 and all(label < start for label, start in seen)


def test_calendar_of_fine_steps_is_numbered_in_order(spark):
    d = spark.range(5000).select(F.lit("s").alias("series"),
                                 (F.lit(DAY0) + F.make_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"), "id")
    out = va.with_steps(d).where("t != id").count()
    assert out == 0
    assert va.with_steps(d.limit(0)).count() == 0
