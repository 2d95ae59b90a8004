"""Plans without an oracle SQL (fits, searches, streams, resampling) must run on
the smallest tables and keep their invariants."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

QUERIES = E.queries()
SQL = E.oracle_sql()
FAST = ["g30_kde_grid", "q07_partial_autocorrelation", "h12_tukey_hsd", "h17_ks_normality",
        "v17_bootstrap_interval", "l02_kmeans_labels", "l05_given_label_scores",
        "vf13_pca", "vf05_power_transforms", "a02_ridge_lasso"]


def test_rows_only_plans_are_registered_without_sql():
    rows_only = set(QUERIES) - set(SQL)
    assert set(FAST) <= rows_only


@pytest.mark.parametrize("name", FAST)
def test_rows_only_plan_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0


def test_bootstrap_interval_contains_estimate(spark, sf_dir):
    r = QUERIES["v17_bootstrap_interval"](spark, sf_dir).first()
    assert r["lower"] <= r["estimate"] <= r["upper"]


def test_stream_goes_on_after_a_restart_and_closes(spark, tmp_path):
    """Every window equals the batch twin's; a new object on the same root takes
    only what is new; late rows are counted, not summed in."""
    from tabkit.streaming import monitor as MO
    day = lambda d, h: f"2024-03-{d:02d} {h:02d}:00:00"
    arrivals = [[(day(1, 1), 1.0), (day(1, 9), 3.0), (day(2, 5), 5.0)], [(day(4, 2), 7.0)],
                [(day(1, 3), 100.0), (day(4, 8), 9.0), (day(6, 1), 2.0)], []]
    frames = [spark.createDataFrame(a, "t string, v double").select(F.col("t").cast("timestamp_ntz").alias("ts"), "v") for a in arrivals]
    source, root, seen = str(tmp_path / "in"), str(tmp_path / "state"), []
    for i, f in enumerate(frames):
        f.write.parquet(f"{source}/a{i}")
        s = MO.WindowMetricsStream(spark, source, root, f.schema, "ts", F.col("v"), F.lit(0.0), "1 day")
        s.run()
        seen.append(s.results().count())
    assert seen == sorted(seen) and seen[-1] < 4
    s.close()
    kept = frames[0].unionByName(frames[1]).unionByName(frames[2].where("v < 100"))
    want = MO.batch_window_metrics(kept, "ts", F.col("v"), F.lit(0.0), "1 day")
    assert sorted(s.results().collect()) == sorted(want.collect())
    assert s.times.late_rows() == 1


def test_knn_predictions_are_labels(spark, sf_dir):
    out = QUERIES["l07_knn"](spark, sf_dir)
    assert out.where(F.col("prediction").isNull()).count() == 0
