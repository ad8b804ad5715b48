"""Streaming equals batch for the scored history (T1) and latest state."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from cropscope.plans import QUERIES
from cropscope.sources import bindings as B
from cropscope.operators import trend
from cropscope.session import shared_path
from cropscope.streaming import field_state
from cropscope.streaming import observations as S


def test_scored_history_stream_equals_batch(spark):
    streamed = S.read_history(spark, S.run_scored_history(spark, SF_SMALL))
    assert streamed.where(F.col("ingested_at").isNull()).count() == 0
    streamed = streamed.drop("ingested_at")
    batch = S.score_observations(B.observations(spark, SF_SMALL))
    assert streamed.count() == batch.count() == 1000
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_latest_state_stream_equals_batch(spark):
    streamed = S.read_latest_state(spark, S.run_latest_state(spark, SF_SMALL))
    batch = S.latest_state(B.observations(spark, SF_SMALL))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_uncommitted_epoch_is_unseen(spark):
    """A folder without its commit (a restart between the two writes) changes nothing."""
    path = S.run_latest_state(spark, SF_SMALL)
    before = S.read_latest_state(spark, path)
    n = before.count()
    field_state.fold(B.observations(spark, SF_SMALL).withColumn("ndvi", F.lit(9.0))).write.parquet(
        f"{path}/epochs/epoch=99")
    field_state.fold(B.observations(spark, SF_SMALL).withColumn("ndvi", F.lit(9.0))).write.parquet(
        f"{path}/snapshots/upto=99")
    assert S.read_latest_state(spark, path).where("ndvi = 9.0").count() == 0
    assert S.read_latest_state(spark, path).count() == n


def test_stream_query_registered(spark):
    df = QUERIES["stream_latest_state"](spark, SF_SMALL)
    assert df.where(F.col("n_obs") < 1).count() == 0


def split_events(spark, files):
    """The events table as ``files`` files of mixed times."""
    path = shared_path(spark, "split_events")
    (spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(files, F.xxhash64("event_id"))
     .write.parquet(path))
    return path


def test_trends_after_many_micro_batches(spark):
    """30 micro-batches: the merged state equals the batch trends, and reading it touches one
    snapshot and the epochs since."""
    src = split_events(spark, 30)
    path = S.run_latest_state(spark, src, file_glob="*.parquet", max_files_per_trigger=1, compact_every=8)
    parts = field_state.parts(spark, path)
    assert len([p for p in parts if "/snapshots/" in p]) == 1 and len(parts) <= 1 + 8
    files = field_state.read(spark, path).inputFiles()
    assert files and not any("epoch=0/" in f or "epoch=7/" in f for f in files)
    obs = B.observations(spark, SF_SMALL)
    got = {r.field_id: r for r in S.read_trends(spark, path).collect()}
    year = {r.field_id: r for r in trend.trend_per_year(obs).collect()}
    ten = {r.field_id: r for r in trend.trend_first_ten(obs).collect()}
    assert got.keys() == year.keys()
    for k, r in got.items():
        assert r.n_obs == year[k].n_points and r.direction == year[k].direction
        assert abs(r.trend_per_year - year[k].trend_per_year) < 1e-9
        assert abs(r.trend_first_ten - ten[k].trend_per_year) < 1e-9
    batch = S.latest_state(obs)
    assert S.read_latest_state(spark, path).exceptAll(batch).count() == 0
    before = S.read_latest_state(spark, path).count()
    field_state.compact(spark, path)
    field_state.expire(spark, path)
    assert len(field_state.parts(spark, path)) == 1
    assert S.read_latest_state(spark, path).count() == before
    assert S.read_latest_state(spark, path).exceptAll(batch).count() == 0


def test_epoch_written_again_counts_once(spark):
    obs = B.observations(spark, SF_SMALL)
    path = shared_path(spark, "epoch_again")
    for epoch in (0, 1, 1):
        field_state.write_epoch(obs.where(F.col("event_id") % 2 == epoch), epoch, path)
    assert S.read_latest_state(spark, path).exceptAll(S.latest_state(obs)).count() == 0


def test_state_of_odd_rows(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t, None), (1, 2, None, 0.5), (None, 3, t, 0.1), (None, 4, t + dt.timedelta(days=10), 0.2),
            (2, 5, t, 0.3), (2, 6, t, 0.9)]
    obs = spark.createDataFrame(rows, "field_id long, event_id long, ts timestamp_ntz, ndvi double")
    path = shared_path(spark, "odd_state")
    for k, r in enumerate(rows):
        field_state.write_epoch(obs.where(F.col("event_id") == r[1]), k, path, compact_every=3)
    got = {r.field_id: r for r in S.read_trends(spark, path).collect()}
    assert got[1].n_obs == 2 and got[1].trend_per_year == 0.0
    assert abs(got[None].trend_per_year - 0.01 * 365) < 1e-9
    assert got[2].trend_per_year == 0.0 and got[2].direction == "declining"     # one day only


def test_a_file_delivered_twice_adds_nothing(spark):
    import shutil
    src = shared_path(spark, "twice")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.coalesce(1).write.parquet(f"{src}/first")
    without_id = events.limit(3).withColumn("event_id", F.lit(None).cast("long"))
    without_id.coalesce(1).write.parquet(f"{src}/none")
    import glob
    import os
    os.makedirs(f"{src}/in")
    for k, name in enumerate(("first", "none", "first", "none")):
        shutil.copy(glob.glob(f"{src}/{name}/*.parquet")[0], f"{src}/in/events-{k}.parquet")
    path = S.run_scored_history(spark, f"{src}/in", file_glob="events-*.parquet", max_files_per_trigger=1)
    got = S.read_history(spark, path)
    assert got.where("event_id is not null").count() == events.count()
    assert got.select("event_id").where("event_id is not null").distinct().count() == events.count()
    assert got.where("event_id is null").count() == without_id.distinct().count()


def test_streams_over_an_empty_folder(spark):
    import os
    src = shared_path(spark, "nothing")
    os.makedirs(src)
    history = S.run_scored_history(spark, src)
    assert S.read_history(spark, history).count() == 0
    assert "predicted_yield" in S.read_history(spark, history, with_yield=True).columns
    state = S.run_latest_state(spark, src)
    assert S.read_latest_state(spark, state).count() == 0
    assert S.read_trends(spark, state).columns[0] == "field_id"


def test_fold_gathers_no_fields_on_the_driver(spark):
    state = field_state.fold(B.observations(spark, SF_SMALL))
    state.collect()
    assert "Broadcast" not in state._jdf.queryExecution().executedPlan().toString()
