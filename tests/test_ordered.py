"""Split windows against pandas on whole series, and hourly sequences."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from thermolane.operators import ordered
from tests.conftest import rows


@pytest.fixture(scope="module")
def series(spark):
    """One unit holds most rows; gaps span whole days; one unit has no value at all."""
    rng = np.random.default_rng(7)
    n = 900
    unit = np.where(np.arange(n) % 3 > 0, "hot", np.where(np.arange(n) % 2 > 0, "cold", "none"))
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.permutation(n) * 17, unit="min"),
            "unit": unit,
            "x": np.where(rng.random(n) < 0.3, rng.random(n).round(3), np.nan),
            "off": rng.random(n) < 0.2,
        }
    )
    pdf.loc[pdf.unit == "none", "x"] = np.nan
    day = pdf.ts.dt.dayofyear
    pdf.loc[day.isin([1, 4, 5, 6, 11]), "x"] = np.nan
    df = spark.createDataFrame(pdf)
    return pdf.sort_values("ts"), df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def check(df, want, column="x"):
    got = df.toPandas().set_index("id")[column].astype(float)
    np.testing.assert_allclose(got.sort_index(), want.sort_index().astype(float), rtol=1e-9)


@pytest.mark.parametrize("bucket", ["day", "range"])
@pytest.mark.parametrize("keys", [["unit"], []])
def test_interpolation_equals_whole_series(series, keys, bucket):
    pdf, df = series
    groups = pdf.groupby("unit").x if keys else None
    want = groups.transform(lambda s: s.interpolate("linear")) if keys else pdf.x.interpolate("linear")
    want.index = pdf.id
    by = F.to_date("ts") if bucket == "day" else None
    check(ordered.interpolate_linear(df, "x", keys, ["ts"], by), want)


@pytest.mark.parametrize("bucket", ["day", "range"])
@pytest.mark.parametrize("keys", [["unit"], []])
def test_conditional_fill_equals_whole_series(series, keys, bucket):
    pdf, df = series
    fill = lambda g: g.x.ffill() if (g.off & g.x.isna()).any() else g.x
    want = pd.concat([fill(g) for _, g in pdf.groupby("unit")]) if keys else fill(pdf)
    want = want.rename(index=pdf.id)
    by = F.to_date("ts") if bucket == "day" else None
    check(ordered.fill_forward_when(df, ["x"], F.col("off"), keys, ["ts"], by), want)


def test_fill_leaves_series_without_trigger(frame):
    df = frame("u string, ts int, x double, off boolean",
               ("a", 1, 1.0, False), ("a", 2, None, False), ("b", 1, 1.0, False), ("b", 2, None, True),
               ("b", 3, None, False))
    out = ordered.fill_forward_when(df, ["x"], F.col("off"), ["u"], ["ts"], F.lit(0))
    assert rows(out.select("u", "ts", "x"), "u", "ts") == [
        ("a", 1, 1.0), ("a", 2, None), ("b", 1, 1.0), ("b", 2, 1.0), ("b", 3, 1.0)]


def test_positions_and_split(series):
    pdf, df = series
    got = ordered.row_positions(df, [], ["ts"], F.to_date("ts")).toPandas().sort_values("ts")
    assert list(got.pos) == list(range(1, len(pdf) + 1))
    split = ordered.chronological_split(df, ["ts"]).toPandas().sort_values("ts")
    assert list(split.is_train) == [True] * 720 + [False] * 180


def test_hour_blocks(frame):
    df = frame("d int, hour int", (1, 8), (1, 9), (1, 10), (1, 13))
    got = rows(ordered.hour_blocks(df, ["d"], 2).select("hour", "block_start"), "hour")
    assert got == [(8, 8), (9, 8), (10, 10), (13, 13)]


def test_runs_spans_and_interval(frame):
    df = frame("z string, ts timestamp, u int",
               *[("a", f"2024-01-01 0{h}:00:00", u) for h, u in enumerate([1, 1, 0, 0, 2, 0])])
    on = F.col("u") > 0
    run = ordered.run_lengths(df, on, ["z"], "ts", "n")
    assert [r[0] for r in rows(run.select("n", "ts"), "ts")] == [1, 2, 0, 0, 1, 0]
    spans = ordered.off_spans(df, on, ["z"])
    got = rows(spans.select(F.hour("span_start"), F.hour("span_end"), "off_rows"), "span_start")
    assert got == [(2, 4, 2), (5, 5, 1)]
    assert rows(ordered.sampling_interval(df, ["z"])) == [("a", 3600.0)]
    one = df.where("ts = '2024-01-01'")
    assert rows(ordered.sampling_interval(one, ["z"])) == [("a", 3600.0)]


def test_lag_takes_itself_at_the_start(frame):
    df = frame("z string, ts int, x double", ("a", 1, 5.0), ("a", 2, None), ("a", 3, 7.0))
    got = rows(ordered.lag_or_self(df, "x", ["z"], "ts", "l").select("ts", "l"), "ts")
    assert got == [(1, 5.0), (2, 5.0), (3, 7.0)]


def test_ranges_split_one_hot_key_at_one_time(spark):
    """All rows share unit and time; the ranges still cut them into tasks of like size."""
    df = spark.range(40000).select(F.lit("u").alias("unit"), F.lit(0).alias("ts"), "id",
                                   F.when(F.col("id") % 9000 == 5, F.col("id").cast("double")).alias("x"))
    out = ordered.interpolate_linear(df, "x", ["unit"], ["ts", "id"])
    assert out.where("id >= 5 AND id <= 36005 AND abs(x - id) > 1e-6").count() == 0
    assert out.where("x IS NULL").count() == 5 and out.where("id > 36005 AND x <> 36005").count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = ordered.with_buckets(df, ["unit"], ["ts", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = ranged.groupBy("__bucket").count().toPandas()["count"]
    assert len(sizes) > 4 and sizes.max() < 2 * sizes.mean()
