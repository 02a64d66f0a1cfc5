"""What is kept beside the rows or taken while they are written: sketches, reports, batches, samples, moments."""

from __future__ import annotations

import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from waitspark.functions.text import cell_text
from waitspark.operators.distributions import correlation_matrix, density_curve
from waitspark.operators.fences import Fence, Fences
from waitspark.operators.moments import PairMoments, pair_moments
from waitspark.operators.observed import cleaning_steps, observed_steps, write_observed
from waitspark.operators.sketches import sketched_fences, sketched_quantiles, update_sketches
from waitspark.plans.charts import chart_summary
from waitspark.schema import FEATURES, HISTOGRAM_FEATURES, TARGET
from waitspark.sources import (
    append_months,
    commit_batch,
    files_over,
    manifest,
    read_months,
    read_trips,
    sample_files,
    stage_batch,
    table_rows,
    top_elements,
)
from waitspark.workspace import discard, materialize

# Sketches


def test_sketches_merge_months_without_reading_old_ones(spark, tmp_path):
    path = str(tmp_path / "sketches")
    rng = np.random.default_rng(8)
    values = {m: rng.lognormal(0, 1 + m / 6, 4000) for m in (1, 2, 3)}
    for m, v in values.items():
        frame = pd.DataFrame({"trip_month": m, "a": v, "b": np.where(v > 3, np.nan, 7.0)})
        update_sketches(spark.createDataFrame(frame), path, ["a", "b"])
    whole = np.sort(np.concatenate(list(values.values())))
    found = {r["column_name"]: r for r in sketched_quantiles(spark, path, (0.05, 0.25, 0.5, 0.75, 0.95)).collect()}
    for p, q in zip((0.05, 0.25, 0.5, 0.75, 0.95), found["a"]["quantiles"]):
        assert np.searchsorted(whole, q) / len(whole) == pytest.approx(p, abs=0.01)
    assert found["a"]["rows"] == 12_000 and found["b"]["rows"] == int((whole <= 3).sum())
    assert set(found["b"]["quantiles"]) == {7.0}
    one = sketched_quantiles(spark, path, (0.5,), months=[2]).filter("column_name = 'a'").first()
    assert one["rows"] == 4000


def test_a_month_that_comes_again_replaces_its_sketches(spark, tmp_path):
    path = str(tmp_path / "sketches")
    for value in (1.0, 5.0):
        update_sketches(spark.createDataFrame([(1, value)] * 10, "trip_month int, a double"), path, ["a"])
    update_sketches(spark.createDataFrame([(2, None)], "trip_month int, a double"), path, ["a"])
    row = sketched_quantiles(spark, path, (0.5,)).first()
    assert (row["rows"], row["quantiles"]) == (10, [5.0])


def test_sketched_fences(spark, tmp_path):
    path = str(tmp_path / "sketches")
    rows = spark.createDataFrame([(1, float(i), None) for i in range(1001)], "trip_month int, a double, empty double")
    update_sketches(rows, path, ["a", "empty"])
    fences = sketched_fences(spark, path, ["a", "empty"])
    low, high = fences.steps[0].lower, fences.steps[0].upper
    assert low == pytest.approx(-500, abs=60) and high == pytest.approx(1500, abs=60)
    assert fences.steps[1].lower is None and fences.apply(rows).count() == 0


# Observed reports


def jobs_of(spark, work):
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reports_need_no_job_of_their_own(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(start, start + dt.timedelta(minutes=i - 3) if i % 5 else None, i if i % 7 else None, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "request_datetime timestamp, on_scene_datetime timestamp, key int, wait double")
    fences = Fences([Fence("wait", 5.0, 30.0, 0)], 0)
    steps = cleaning_steps(["key"], df, fences)
    kept = df.filter("request_datetime <= on_scene_datetime AND key IS NOT NULL AND wait BETWEEN 5 AND 30")
    reports = []
    plain = jobs_of(spark, lambda: kept.write.parquet(str(tmp_path / "plain")))
    watched = jobs_of(spark, lambda: reports.append(write_observed(df, steps, str(tmp_path / "watched"))))
    assert watched == plain
    assert spark.read.parquet(str(tmp_path / "watched")).count() == kept.count()
    got = [(r["name"], r["rows_before"], r["rows_removed"], r["rows_after"]) for r in reports[0].collect()]
    in_order = df.filter("request_datetime <= on_scene_datetime")
    n = [40, in_order.count(), in_order.filter("key IS NOT NULL").count(), kept.count()]
    assert got == [
        ("time order", n[0], n[0] - n[1], n[1]),
        ("keys present", n[1], n[1] - n[2], n[2]),
        ("fence wait", n[2], n[2] - n[3], n[3]),
        ("(all)", n[0], n[0] - n[3], n[3]),
    ]


def test_observed_steps_of_nothing(spark):
    observed = observed_steps(spark.createDataFrame([], "a int"), [("positive", F.col("a") > 0)])
    assert observed.data.count() == 0
    assert [r["rows_after"] for r in observed.report(spark).collect()] == [0, 0]


# Batches of months


def month_rows(spark, months, n=10):
    return spark.createDataFrame([(m, i) for m in months for i in range(n)], "trip_month int, v int")


def test_a_stopped_batch_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "months")
    append_months(month_rows(spark, [1, 2]), path, "a", batch_size=4)
    stage_batch(month_rows(spark, [2, 3], 99), path, "trip_month")
    assert read_months(spark, path).count() == 20
    assert files_over(spark, path, 4) == 0
    sizes = {r["file"]: r["bytes"] for r in manifest(spark, path).collect()}
    assert len(sizes) >= 6 and min(sizes.values()) > 0


def test_a_commit_looks_its_files_up_in_tasks(spark, tmp_path, monkeypatch):
    from waitspark.sources import batches

    path = str(tmp_path / "some months")
    rows = month_rows(spark, [1, 2], 50).withColumn("trip_month", F.concat(F.lit("2024:"), F.col("trip_month").cast("string")))
    folder = stage_batch(rows, path, "trip_month", 3)
    listed = []
    monkeypatch.setattr(batches, "_children", lambda spark, at: listed.append(at) or [])
    commit_batch(spark, path, folder, "a", "trip_month")
    assert listed == [f"{path}/_commits"]
    monkeypatch.undo()
    got = {(r["month"], r["file"]): r["bytes"] for r in manifest(spark, path).collect()}
    disk = {(f.parent.name.partition("=")[2], f.name): f.stat().st_size for f in (tmp_path / "some months" / folder).glob("*/*.parquet")}
    assert got == disk and len(got) >= 34
    assert read_months(spark, path).count() == 100 and files_over(spark, path, 3) == 0
    append_months(rows.filter("v < 0"), path, "none")
    assert read_months(spark, path).count() == 100


def test_a_rerun_replaces_its_months(spark, tmp_path):
    path = str(tmp_path / "months")
    append_months(month_rows(spark, [1, 2]), path, "a")
    append_months(month_rows(spark, [2, 3], 5), path, "b")
    append_months(month_rows(spark, [2, 3], 6), path, "b")
    counts = {r["trip_month"]: r["count"] for r in read_months(spark, path).groupBy("trip_month").count().collect()}
    assert counts == {1: 10, 2: 6, 3: 6}


def test_an_older_attempt_cannot_commit_over_a_newer_one_in_part(spark, tmp_path):
    path = str(tmp_path / "months")
    slow = stage_batch(month_rows(spark, [1], 3), path, "trip_month")
    append_months(month_rows(spark, [1, 2], 8), path, "a")
    commit_batch(spark, path, slow, "a", "trip_month")
    counts = {r["trip_month"]: r["count"] for r in read_months(spark, path).groupBy("trip_month").count().collect()}
    assert counts == {1: 3, 2: 8}
    with pytest.raises(FileNotFoundError):
        read_months(spark, str(tmp_path / "nothing"))


# Files


def test_folders_and_files_named_like_parts(spark, tmp_path):
    folders = tmp_path / "folders"
    for i in range(2):
        spark.range(5).selectExpr("id AS PULocationID").write.parquet(str(folders / f"part-{i}.parquet"))
    assert read_trips(spark, str(folders)).count() == 10
    files = tmp_path / "files"
    files.mkdir()
    for i, kind in enumerate(("int32", "int64", "int64")):
        pd.DataFrame({"PULocationID": np.arange(4, dtype=kind)}).to_parquet(files / f"part-{i}.parquet")
    rows = read_trips(spark, str(files))
    assert rows.count() == 12 and dict(rows.dtypes) == {"PULocationID": "bigint"}


def test_each_file_is_sampled_by_itself(spark, tmp_path):
    for i, n in enumerate((4000, 1000)):
        pd.DataFrame({"v": np.arange(n)}).to_parquet(tmp_path / f"m{i}.parquet", row_group_size=300)
    found = []
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = read_trips(spark, str(tmp_path), file="file_path", row="row_index")
        found.append(sorted((r["file_path"], r["v"]) for r in sample_files(rows, 0.2).collect()))
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1]
    shares = pd.DataFrame(found[0], columns=["f", "v"]).groupby("f").size()
    assert shares.iloc[0] == pytest.approx(800, abs=160) and shares.iloc[1] == pytest.approx(200, abs=80)
    assert set(read_trips(spark, str(tmp_path), schema=rows.select("v").schema, row="at").columns) == {"v", "at"}


# Pages


@pytest.mark.parametrize(
    ("markup", "rows"),
    [
        ("<tr><td>a</td></tr><tr><td>b</td></tr>", ["<td>a</td>", "<td>b</td>"]),
        ("<tr><td><table><tr><td>x</td></tr></table></td></tr>", ["<td><table><tr><td>x</td></tr></table></td>"]),
        ("<tr>1<tr>2</table><tr>3</tr>", ["1", "2"]),
        ("<TR class='a'>1</TR><!-- <tr>no</tr> --><tr>2", ["1", "2"]),
        ("<tr></tr><track>x</track>", [""]),
        ("no rows < here", []),
        ("", []),
        ("<tr><table><tr><table><tr>deep</tr></table></tr></table>end</tr><tr>y</tr>",
         ["<table><tr><table><tr>deep</tr></table></tr></table>end", "y"]),
    ],
)
def test_top_elements(spark, markup, rows):
    df = spark.createDataFrame([(markup,)], "m string")
    assert df.select(top_elements(F.col("m"), "tr")).first()[0] == rows


def test_table_rows_of_null_and_other_pages(spark):
    page = "<table id=t><tr><td>a<table id=u><tr><td>b</td></tr></table></td><td>c</td></tr></table><table><tr><td>no</td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "<p>")], "k int, html string")
    rows = table_rows(df, ["k"], "t").collect()
    assert [(r["k"], r["position"]) for r in rows] == [(1, 0)]
    cells = table_rows(df, ["k"], "t").select(F.transform(top_elements(F.col("markup"), "td"), cell_text)).first()[0]
    assert cells == ["ab", "c"]


# Moments, densities, charts


def test_correlations_of_fifty_columns_with_gaps(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(900, 50)) @ rng.normal(size=(50, 50)) + 1e6
    base[rng.random(base.shape) < 0.1] = np.nan
    base[:, 7] = 3.0
    frame = pd.DataFrame(base, columns=[f"c{i}" for i in range(50)])
    df = spark.createDataFrame(frame).withColumn("c3", F.when(~F.isnan("c3"), F.col("c3"))).repartition(7)
    found = correlation_matrix(df, list(frame.columns)).toPandas().pivot(index="row_name", columns="column_name", values="r")
    want = frame.corr().to_numpy()
    got = found.loc[frame.columns, frame.columns].to_numpy(dtype=float)
    assert np.array_equal(np.isnan(got), np.isnan(want))
    assert np.nanmax(np.abs(got - want)) < 1e-8


def test_moments_merge(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3)) * [1, 10, 100] + [0, 1e5, 5]
    present = rng.random(x.shape) > 0.2
    x = np.where(present, x, 0.0)
    whole = PairMoments.of(x, present)
    parts = PairMoments.of(x[:1], present[:1]).merge(PairMoments.of(x[1:150], present[1:150])).merge(PairMoments.of(x[150:], present[150:]))
    for name in ("n", "mean", "square", "cross"):
        assert getattr(parts, name) == pytest.approx(getattr(whole, name), rel=1e-9, abs=1e-7)
    empty = pair_moments(spark.createDataFrame([], "a double, b double"), ["a", "b"])
    assert np.isnan(empty.correlations()).all()


def test_density_ignores_what_is_no_number_and_shuffles_no_values(spark):
    values = np.random.default_rng(4).normal(size=3000)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    gaps = df.unionByName(spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "v double"))
    one, two = (density_curve(d, "v").orderBy("point").toPandas() for d in (df, gaps))
    assert one["density"].to_numpy() == pytest.approx(two["density"].to_numpy())
    plan = density_curve(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(place" in plan and "hashpartitioning(value" not in plan


def test_chart_summary_skips_gaps(spark):
    columns = [*dict.fromkeys([*FEATURES, TARGET, "trip_month"])]
    rows = [tuple(float(i % (3 + k)) for k in range(len(columns))) for i in range(60)] + [(None, *[1.0] * (len(columns) - 1))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    df = df.withColumns({"PULocationZone": F.lit("Z"), "PUBorough": F.lit("B")})
    shapes = spark.createDataFrame([(1, "Z"), (2, "Y"), (3, "Z")], "shape_id int, zone string")
    found = chart_summary(df, shapes).toPandas()
    counts = found[found["chart"] == "histogram"].groupby("label")["value"].sum()
    assert set(counts.index) == set(HISTOGRAM_FEATURES) and set(counts) == {60.0}
    places = found[found["chart"] == "zone_map"].set_index("place")["value"]
    assert places[2] == 0 and places[1] == places[3] > 0
    assert list(found[found["chart"] == "top_zone"]["label"]) == ["(B) Z"]


def test_discarded_tables_are_gone(spark):
    table = materialize(spark.range(3), "gone")
    path = table.inputFiles()[0]
    discard(table)
    discard(table)
    import os

    assert not os.path.exists(path.removeprefix("file://"))
