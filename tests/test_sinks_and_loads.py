import datetime as dt
import json
import os
from unittest import mock

import pytest
from pyspark.sql import functions as F

from skyloom import Catalog
from skyloom.operators.profile import column_profile, column_sketches, merged_profile, table_profile
from skyloom.plans import datasets, discoveries
from skyloom.plans.load import Loader
from skyloom.sinks import writers
from skyloom.storage import discard, removed, scratch_path, written

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
ROWS = [
    (1, 'say "hi", x', 1.5, dt.datetime(2015, 3, 1, 2, 3, 4), True),
    (2, None, None, None, None),
    (3, "two\nlines", 1e-7, dt.datetime(1999, 12, 31), False),
]
SCHEMA = "n int, t string, d double, ts timestamp_ntz, b boolean"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def catalog(spark):
    return entry.catalog(spark, SF_DIR)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("file_format", list(writers.FORMATS))
def test_files_round_trip_and_replace(spark, table, tmp_path, file_format):
    path = str(tmp_path / "out")
    for _ in range(2):
        writers.write_files(table, path, file_format)
        assert rows(writers.read_files(spark, path, table.schema, file_format)) == ROWS


def test_file_options(spark, table, tmp_path):
    path = str(tmp_path / "out")
    writers.write_files(table, path)
    assert any(name.endswith(".snappy.parquet") for name in os.listdir(path))
    writers.write_files(table, path, "jsonl", compression="gzip")
    assert any(name.endswith(".json.gz") for name in os.listdir(path))
    writers.write_files(spark.range(100).coalesce(1), path, batch_size=30)
    sizes = [spark.read.parquet(f"{path}/{n}").count() for n in os.listdir(path) if n.endswith("parquet")]
    assert sorted(sizes) == [10, 30, 30, 30]
    with pytest.raises(ValueError):
        writers.write_files(table, path, "orc")


def test_a_table_is_never_its_own_source(spark, table, tmp_path):
    path = str(tmp_path / "out")
    writers.write_files(table, path)
    with pytest.raises(Exception, match="(?i)overwrite"):
        writers.write_files(spark.read.parquet(path).where("n > 1"), path)
    with pytest.raises(Exception, match="(?i)overwrite"):
        writers.write_files(spark.read.parquet(path), f"file:{path}/")
    assert spark.read.parquet(path).count() == 3
    writers.write_files(spark.read.parquet(path), f"{path}2")
    target = writers.TableTarget("sink_own", str(tmp_path / "base"))
    target.write(table, "t")
    for own in (target, writers.TableTarget("sink_own")):
        with pytest.raises(Exception, match="(?i)overwrite"):
            own.write(spark.table("sink_own.t").where("n > 1"), "t")
    assert spark.table("sink_own.t").count() == 3


def test_relative_paths_are_seen_through(spark, table, tmp_path):
    folder = f"relative-{tmp_path.name}-{os.getpid()}"
    absolute = os.path.join(os.getcwd(), folder)
    try:
        writers.write_files(table, folder)
        assert spark.read.parquet(absolute).count() == 3
        for source, target in ((absolute, folder), (folder, absolute), (folder, f"./{folder}/")):
            with pytest.raises(ValueError, match="overwrite"):
                writers.write_files(spark.read.parquet(source).where("n > 1"), target)
        assert spark.read.parquet(absolute).count() == 3
    finally:
        removed(spark, folder)


def test_a_failed_write_keeps_the_old_rows(spark, table, tmp_path):
    path = str(tmp_path / "out")
    failing = table.withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("n")))
    target = writers.TableTarget("sink_failed", str(tmp_path / "base"))
    plain = writers.TableTarget("sink_failed_plain")
    writers.write_files(table, path)
    target.write(table, "t")
    plain.write(table, "t")
    for write in (lambda: writers.write_files(failing, path), lambda: target.write(failing, "t"),
                  lambda: plain.write(failing, "t")):
        with pytest.raises(Exception, match="stop"):
            write()
    assert rows(spark.read.parquet(path)) == ROWS
    assert rows(spark.table("sink_failed.t")) == rows(spark.table("sink_failed_plain.t")) == ROWS
    assert sorted(os.listdir(tmp_path)) == ["base", "out"]
    stored = [t.name for t in spark.catalog.listTables("sink_failed_plain") if not t.isTemporary]
    assert stored == ["t"]


def test_loads_leave_nothing_behind_and_know_their_schema(spark, catalog, tmp_path):
    def staged():
        shared = spark.conf.get("spark.checkpoint.dir") + "/skyloom"
        return {n for n in (os.listdir(shared) if os.path.isdir(shared) else []) if n.startswith("staged")}

    loader = Loader(catalog, writers.FileTarget(str(tmp_path)))
    before = staged()
    (done,) = loader.load_custom_query("SELECT pl_name, '12' AS extra FROM ps", "open", limit=5)
    assert done.rows == 5 and dict(spark.read.parquet(done.location).dtypes)["extra"] == "bigint"
    (done,) = loader.load_tess_data(limit=5)
    assert dict(spark.read.parquet(done.location).dtypes)["toi"] == "double"
    odd = Catalog(spark, {"toi": catalog.table("toi").withColumn("toi", F.lit("odd"))})
    (done,) = Loader(odd, writers.FileTarget(str(tmp_path))).load_tess_data()
    loaded = spark.read.parquet(done.location)
    assert dict(loaded.dtypes)["toi"] == "double"
    assert loaded.where("toi IS NULL AND toi_unparsed = 'odd'").count() == done.rows > 0
    assert staged() == before


def test_catalog_on_a_path_and_views_of_the_user(spark, table, tmp_path):
    for name in ("ps", "toi"):
        table.write.parquet(f"{tmp_path}/{name}")
    (tmp_path / "_logs").mkdir()
    stored = Catalog(spark, base_path=str(tmp_path))
    assert rows(stored.list_tables()) == [("ps", 5, 3), ("toi", 5, 3)]
    assert stored.table_schema("p%").count() == 5
    spark.range(1).createOrReplaceTempView("ps")
    try:
        assert stored.sql("SELECT n FROM ps").count() == 3
        assert spark.table("ps").columns == ["id"]
        assert "toi" not in [t.name for t in spark.catalog.listTables()]
        assert Catalog(spark).names() == ["ps"]
    finally:
        spark.catalog.dropTempView("ps")
    named = stored.query().select(["ps.n", "t"]).from_table("ps").where("ps.n > 1").order_by("ps.n")
    assert [r.n for r in named.to_df().collect()] == [2, 3]
    assert Catalog(spark, base_path=str(tmp_path / "nothing")).list_tables().count() == 0


def test_catalog_table(spark, table, tmp_path):
    target = writers.TableTarget("sink_test", str(tmp_path))
    for _ in range(2):
        target.write(table, "t")
    assert rows(spark.table("sink_test.t")) == ROWS
    writers.TableTarget("sink_plain").write(table, "t")
    assert spark.table("sink_plain.t").count() == 3


def test_jdbc_options():
    """Without a database: the options that reach the writer."""
    df = mock.MagicMock()
    writers.JdbcTarget("jdbc:x", "cat", {"user": "u"}, batch_size=500).write(df, "t")
    writer = df.repartition.return_value.write.mode.return_value
    df.repartition.assert_called_once_with(8)
    df.repartition.return_value.write.mode.assert_called_once_with("overwrite")
    options = [writer.option.call_args, writer.option.return_value.option.call_args]
    assert [o.args for o in options] == [("truncate", True), ("batchsize", 500)]
    writer.option.return_value.option.return_value.jdbc.assert_called_once_with(
        "jdbc:x", "cat.t", properties={"user": "u"}
    )


def test_rows_as_text(table):
    first, second, third = (json.loads(r.json) for r in writers.rows_to_json(table).collect())
    assert first["t"] == 'say "hi", x' and second == dict.fromkeys(["t", "d", "ts", "b"]) | {"n": 2}
    assert third["t"] == "two\nlines"
    lines = [r.csv for r in writers.rows_to_csv(table.select("n", "t", "b")).collect()]
    assert lines[:2] == ['1,"say ""hi"", x",true', "2,,"]


def test_profiles(spark, table):
    profile = column_profile(table, approx_distinct=True).orderBy("position").collect()
    assert [(r.column_name, r.data_type, r.rows, r.nulls) for r in profile] == [
        ("n", "int", 3, 0), ("t", "string", 3, 1), ("d", "double", 3, 1),
        ("ts", "timestamp_ntz", 3, 1), ("b", "boolean", 3, 1),
    ]
    assert [r.approx_distinct for r in profile] == [3, 2, 2, 2, 2]
    many = column_profile(spark.range(100000).select(F.col("id") % 5000), approx_distinct=True)
    assert abs(many.first().approx_distinct - 5000) < 500
    tables = table_profile(spark, {"a": table, "b": table.limit(1)})
    assert rows(tables) == [("a", 5, 3), ("b", 5, 1)]
    assert table_profile(spark, {}).count() == 0


def test_datasets(catalog):
    ps = catalog.table("ps")
    assert datasets.confirmed_planets(catalog, limit=7).count() == 7
    year = datasets.confirmed_planets(catalog, filters={"disc_year": 2018})
    assert year.count() == ps.where("soltype LIKE '%Conf%' AND default_flag = 1 AND disc_year = 2018").count()
    assert datasets.planets_with_mass(catalog, max_mass=0).count() == (
        ps.where("pl_masse > 0 AND default_flag = 1").count()
    )
    assert datasets.planets_with_mass(catalog, 100, 200, limit=3).count() == 3
    assert datasets.systems_overview(catalog, limit=5).distinct().count() == 5
    assert datasets.tess_candidates(catalog, "PC").select("tfopwg_disp").distinct().count() == 1
    assert set(datasets.dataset_group(catalog, "exoplanets")) == {
        "confirmed_planets", "candidate_planets", "planets_with_mass",
    }


def test_which_exoplanet_tables_are_loaded(catalog, tmp_path):
    loader = Loader(catalog, writers.FileTarget(str(tmp_path)))

    def tables(**choice):
        return [done.table for done in loader.load_exoplanets(limit=5, **choice)]

    assert tables() == ["confirmed_planets"]
    assert tables(confirmed_only=False) == ["confirmed_planets"]
    assert tables(include_candidates=True) == ["confirmed_planets", "candidate_planets"]
    assert tables(confirmed_only=False, include_candidates=True) == ["candidate_planets"]


@pytest.mark.parametrize("file_format", ["csv", "jsonl"])
def test_load_formats_and_caps(spark, catalog, tmp_path, file_format):
    target = writers.FileTarget(str(tmp_path), file_format, dataset="dev")
    loader = Loader(catalog, target, max_records=40)
    (done,) = loader.load_tess_data()
    assert done == ("tess", "tess_candidates", 40, f"{tmp_path}/dev/tess_candidates")
    schema = loader.clean(datasets.tess_candidates(catalog)).schema
    assert writers.read_files(spark, done.location, schema, file_format).count() == 40
    assert loader.load_tess_data(limit=3)[0].rows == 3
    assert loader.load_kepler_data("CONFIRMED", limit=0)[0].rows == 40
    assert loader.load_custom_query(datasets.kepler_objects(catalog), "all")[0].rows == 200


def test_load_custom_queries(spark, catalog, tmp_path):
    loader = Loader(catalog, writers.FileTarget(str(tmp_path)))
    text = "SELECT pl_name, pl_masse, 'Transit' AS discoverymethod FROM ps WHERE pl_masse > 300"
    (done,) = loader.load_custom_query(text, "heavy")
    loaded = spark.read.parquet(done.location)
    assert done.rows == loaded.count() > 0
    assert loaded.agg(F.max("pl_masse")).first()[0] < 10
    assert {r[0] for r in loaded.select("discoverymethod").distinct().collect()} == {"transit"}
    query = discoveries.recent_discoveries(catalog)
    assert loader.load_custom_query(query, "recent")[0].rows == 10
    assert loader.load_custom_query(query)[0].table == "custom_data"
    assert loader.load_custom_query("SELECT * FROM toi WHERE toi = 'none'", "none")[0].rows == 0
    assert spark.read.parquet(f"{tmp_path}/catalogue/none").count() == 0


def test_load_all(catalog, tmp_path):
    loader = Loader(catalog, writers.FileTarget(str(tmp_path), batch_size=50), clean=None)
    summary = loader.load_all_datasets(limit_per_dataset=120)
    assert [(r.dataset, r.rows) for r in summary.collect()] == [
        ("exoplanets", 120), ("planetary_systems", 120), ("tess", 120), ("kepler", 120),
        ("microlensing", 120),
    ]


def test_load_into_tables(spark, catalog, tmp_path):
    target = writers.TableTarget("load_test", str(tmp_path))
    (done,) = Loader(catalog, target).load_microlensing_data()
    assert done.location == "load_test.microlensing_events"
    assert spark.table(done.location).count() == done.rows == 150


def test_units_survive_in_parquet(spark, catalog, tmp_path):
    (done,) = Loader(catalog, writers.FileTarget(str(tmp_path))).load_microlensing_data()
    stored = Catalog(spark, {"ml": spark.read.parquet(done.location)})
    units = {r.column_name: r.unit for r in stored.table_schema("ml").collect()}
    assert units["pl_masse"] == "Jupiter masses" and units["ra"] is None


def test_shared_folder(spark, tmp_path):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
    table = written(spark.range(3), "x")
    assert rows(table) == [(0,), (1,), (2,)] and os.path.isdir(table.written_to)
    discard(table)
    assert not os.path.exists(table.written_to)


def test_profiles_of_loads_are_merged(spark, tmp_path):
    def load(low, high):
        rows = spark.range(low, high, numPartitions=3)
        return rows.select(
            F.col("id").alias("whole"), (F.col("id") % 1000).cast("string").alias("text"),
            F.when(F.col("id") % 4 > 0, F.col("id") / 2).alias("half"), F.lit(None).cast("double").alias("none"),
            F.array("id").alias("list"), F.lit(float("nan")).alias("nan"),
        )

    for i, (low, high) in enumerate([(0, 20000), (10000, 30000), (5, 5)]):
        column_sketches(load(low, high)).write.parquet(str(tmp_path / f"load={i}"))
    stored = spark.read.parquet(str(tmp_path))
    found = {r["column_name"]: r for r in merged_profile(stored, [0.0, 0.5, 1.0]).collect()}
    assert [found[n]["position"] for n in ("whole", "text", "half", "none", "list", "nan")] == list(range(6))
    assert {(r["rows"]) for r in found.values()} == {40000}
    assert {n: r["nulls"] for n, r in found.items()} == {
        "whole": 0, "text": 0, "half": 10000, "none": 40000, "list": 0, "nan": 0}
    for name, exact in (("whole", 30000), ("text", 1000), ("half", 22500), ("none", 0), ("list", 30000), ("nan", 1)):
        assert abs(found[name]["approx_distinct"] - exact) <= 0.05 * exact
    assert found["text"]["quantiles"] is found["none"]["quantiles"] is found["nan"]["quantiles"] is None
    low, middle, high = found["whole"]["quantiles"]
    assert (low, high) == (0.0, 29999.0) and abs(middle - 15000) < 1200
    whole = {r["column_name"]: r for r in merged_profile(column_sketches(load(0, 20000).unionByName(load(10000, 30000)))).collect()}
    assert whole["whole"]["rows"] == 40000 and whole["text"]["approx_distinct"] == found["text"]["approx_distinct"]
    assert merged_profile(stored.where("false")).count() == 0
