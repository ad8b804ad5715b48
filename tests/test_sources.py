"""Sources and sinks: file listings, stacked label sections, NDVI output."""

import os
import tempfile

from pyspark.sql import functions as F

from cropscope.functions import paths as P
from cropscope.sources import checked, files

# Two sections with different headers stacked in one file.
LABELS_CSV = """filename,yield
plot_a.tif,1.1
plot_b.tif,4.25
plot_c.tif,0.5
filename,yield,rainfall,temperature,soil_ph,fertilizer,region
plot_a.tif,1.1,77,18.5,5.9,45,Valley
"""


def test_label_sections_fullest_row(spark):
    d = tempfile.mkdtemp(prefix="labels-")
    with open(os.path.join(d, "labels.csv"), "w") as fh:
        fh.write(LABELS_CSV)
    got = {r.filename: r for r in files.read_label_sections(spark, d).collect()}
    assert len(got) == 3
    assert got["plot_a.tif"].region == "Valley" and got["plot_a.tif"].rainfall == 77.0
    assert got["plot_b.tif"]["yield"] == 4.25
    assert got["plot_b.tif"].region is None and got["plot_c.tif"].soil_ph is None


def test_raster_listing_rules(spark):
    root = tempfile.mkdtemp(prefix="rasters-")
    names = ["a.tif", "b.TIFF", "c_NDVI.tif", "d.png", "e.Tif"]
    for n in names:
        with open(os.path.join(root, n), "wb") as fh:
            fh.write(b"x")
    listing = files._listing(spark, root, recursive=False)
    got = sorted(r.filename for r in files.rasters(listing).collect())
    assert got == ["a.tif", "b.TIFF", "c_NDVI.tif", "e.Tif"]
    inputs = {r.filename: r.output_path for r in files.ndvi_inputs(listing).collect()}
    assert set(inputs) == {"a.tif", "b.TIFF", "e.Tif"}
    assert inputs["b.TIFF"].endswith("b_NDVI.TIFF") and inputs["e.Tif"].endswith("e_NDVI.Tif")


def test_series_tree(spark):
    root = tempfile.mkdtemp(prefix="series-")
    layout = {"f1": ["20240101_a.tif", "20240111_b.tif", "notes.txt"], "f2": ["bad_x.tif"],
              "f3": ["20240101_a.TIF"]}
    for field, fs in layout.items():
        os.makedirs(os.path.join(root, field))
        for n in fs:
            with open(os.path.join(root, field, n), "wb") as fh:
                fh.write(b"x")
    with open(os.path.join(root, "20240101_root.tif"), "wb") as fh:
        fh.write(b"x")                                  # not in a field's folder
    os.makedirs(os.path.join(root, "f1", "sub"))
    with open(os.path.join(root, "f1", "sub", "20240102_deep.tif"), "wb") as fh:
        fh.write(b"x")                                  # one level too deep
    got = files.list_series(spark, root).collect()
    assert len(got) == 3
    fields = sorted({r.field_id for r in got})
    assert fields == ["f1", "f2"]                       # case-sensitive .tif; f3 never appears
    bad = [r for r in got if r.field_id == "f2"][0]
    assert bad.capture_date is None and not bad.date_ok


def test_output_path_any_case(spark):
    df = spark.createDataFrame([("/x/a.tif",), ("/x/b.TIF",), ("/x/c.tiff",), ("/x/d.png",)], "p string")
    got = [r[0] for r in df.select(P.ndvi_output_path("p")).collect()]
    assert got == ["/x/a_NDVI.tif", "/x/b_NDVI.TIF", "/x/c_NDVI.tiff", "/x/d.png"]


def test_ndvi_output_partitioned(spark):
    from cropscope.session import shared_path
    df = spark.createDataFrame([(1, 0.5, False), (2, -1.0, True)], "scene_id long, ndvi double, is_masked boolean")
    path = files.write_ndvi(df, shared_path(spark, "test_ndvi"))
    back = files.read_ndvi(spark, path, scene_ids=[2])
    assert [(r.ndvi, r.is_masked) for r in back.collect()] == [(-1.0, True)]
    p = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scene_bucket" in p and "EqualTo(scene_id,2)" in p


def test_ndvi_bucket_read_int_ids(spark):
    from cropscope.session import shared_path
    df = spark.createDataFrame([(i, float(i) / 10, False) for i in range(50)],
                               "scene_id int, ndvi double, is_masked boolean")
    path = files.write_ndvi(df, shared_path(spark, "test_ndvi_int"))
    got = sorted(r.scene_id for r in files.read_ndvi(spark, path, scene_ids=[3, 17, 44]).collect())
    assert got == [3, 17, 44]
    assert files.read_ndvi(spark, path).count() == 50


def test_ndvi_sink_directories_are_bounded(spark):
    from cropscope.session import shared_path
    df = spark.range(5000).select(F.col("id").alias("scene_id"), F.lit(0.1).alias("ndvi"),
                                  F.lit(False).alias("is_masked"))
    path = files.write_ndvi(df, shared_path(spark, "test_ndvi_dirs"), buckets=16)
    dirs = [d for d in os.listdir(path) if d.startswith("scene_bucket=")]
    assert 0 < len(dirs) <= 16
    assert files.read_ndvi(spark, path, scene_ids=[4321], buckets=16).count() == 1


def test_ndvi_files_do_not_grow_with_input_tasks(spark):
    from cropscope.session import shared_path
    counts = []
    for tasks in (2, 40):
        df = spark.range(4000).repartition(tasks).select(
            F.col("id").alias("scene_id"), F.lit(0.1).alias("ndvi"), F.lit(False).alias("is_masked"))
        path = files.write_ndvi(df, shared_path(spark, f"test_ndvi_files_{tasks}"), buckets=8)
        counts.append(sum(n.endswith(".parquet") for _, _, fs in os.walk(path) for n in fs))
    assert counts[1] <= counts[0] + 8


def test_ndvi_read_by_a_table_of_scenes(spark):
    from cropscope.session import shared_path
    df = spark.range(100).select(F.col("id").alias("scene_id"), F.lit(0.1).alias("ndvi"),
                                 F.lit(False).alias("is_masked"))
    path = files.write_ndvi(df, shared_path(spark, "test_ndvi_semi"))
    wanted = spark.range(0, 100, 3).select(F.col("id").alias("scene_id"))
    assert files.read_ndvi(spark, path, scene_ids=wanted).count() == 34


def test_series_of_an_empty_tree(spark):
    root = tempfile.mkdtemp(prefix="series-")
    for tree in (root, root + "/missing"):
        got = files.list_series(spark, tree)
        assert got.count() == 0 and "capture_date" in got.columns


# --- failure records ------------------------------------------------------------------

def reasons(bad):
    return sorted((r.key, r.stage, r.name, r.value, r.reason) for r in bad.collect())


def test_csv_failures_are_recorded(spark):
    from cropscope import schemas
    d = tempfile.mkdtemp(prefix="bad-")
    with open(os.path.join(d, "y.csv"), "w") as fh:
        fh.write("field_id,yield,fertilizer_cost\na,1.5,10\nb,x,20\nc,,\nd,1\ne,1,2,3\nf,NaN,1e3\ng,x,y\n")
    good, bad = checked.read_table_csv(spark, d, schemas.YIELDS, "field_id")
    assert sorted(r.field_id for r in good.collect()) == ["a", "c", "f"]
    assert [f.dataType.simpleString() for f in good.schema] == ["string", "double", "double"]
    assert reasons(bad) == [
        ("b", "parse", "yield", "x", "not a double"),
        ("d", "read", None, "d,1", "wrong number of columns"),
        ("e", "read", None, "e,1,2,3", "wrong number of columns"),
        ("g", "parse", "fertilizer_cost", "y", "not a double"),
        ("g", "parse", "yield", "x", "not a double")]
    assert all(r.source.endswith("y.csv") for r in bad.collect())
    plain = files.read_table_csv(spark, d, schemas.YIELDS).where("field_id in ('a', 'c', 'f')")
    assert good.count() == plain.count() and good.exceptAll(plain).count() == 0


def test_label_failures_are_recorded(spark):
    d = tempfile.mkdtemp(prefix="labels-")
    with open(os.path.join(d, "labels.csv"), "w") as fh:
        fh.write(LABELS_CSV + "plot_d.tif,2,wet,1,1,1,Hill\nplot_e.tif,two\n"
                 "plot_f.tif,1,2,3,4,5,Hill,extra\n")
    good, bad = checked.read_label_sections(spark, d)
    assert good.exceptAll(files.read_label_sections(spark, d).where(
        "filename not in ('plot_d.tif', 'plot_e.tif', 'plot_f.tif')")).count() == 0
    assert good.count() == 3
    assert reasons(bad) == [
        ("plot_d.tif", "parse", "rainfall", "wet", "not a double"),
        ("plot_e.tif", "parse", "yield", "two", "not a double"),
        ("plot_f.tif", "read", None, "plot_f.tif,1,2,3,4,5,Hill,extra", "wrong number of columns")]


def test_unreadable_files_are_recorded(spark):
    d = tempfile.mkdtemp(prefix="files-")
    spark.createDataFrame([(1, 2.0)], "a long, b double").coalesce(1).write.parquet(d + "/ok dir")
    spark.createDataFrame([], "a long, b double").coalesce(1).write.parquet(d + "/none")
    with open(os.path.join(d, "ok dir", "bad.parquet"), "wb") as fh:
        fh.write(b"PAR1 nonsense")
    rows, bad = checked.read_files(spark, d + "/*", "a long, b double")
    assert [(r.a, r.b) for r in rows.collect()] == [(1, 2.0)]
    got = {(r.key.split("-")[0], r.stage, r.reason) for r in bad.collect()}
    assert got == {("bad.parquet", "read", "no readable row"), ("part", "read", "no readable row")}


def test_image_failures(spark):
    nan = float("nan")
    rows = [(1, 1, 0.1), (1, 2, 0.2), (2, 1, 0.1), (3, 3, None), (3, 4, nan), (4, 3, nan), (4, 3, 1.0),
            (4, 4, 1.0), (5, 4, 1.0), (5, 8, None)]
    got = checked.image_failures(spark.createDataFrame(rows, "scene_id long, band int, value double"))
    assert reasons(got) == [
        ("2", "bands", "band_count", "1", "no red and near-infrared band"),
        ("3", "bands", "band", "3", "band without a number"),
        ("3", "bands", "band", "4", "band without a number"),
        ("5", "bands", "band", "8", "band without a number")]
