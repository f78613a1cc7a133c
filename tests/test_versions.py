import os

import pytest
from pyspark.sql import functions as F

from skyloom import Catalog
from skyloom.plans.load import Loader
from skyloom.sinks import versions
from skyloom.sinks.versions import VersionedTarget

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def target(spark, tmp_path):
    return VersionedTarget(spark, str(tmp_path), "d")


def folders(target, table):
    path = f"{target.folder}/{table}"
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_replacing_and_reading(spark, target):
    target.write(spark.range(5), "t")
    first = target.read("t")
    target.write(target.read("t").where("id > 1"), "t")  # from itself
    assert sorted(r.id for r in target.read("t").collect()) == [2, 3, 4]
    assert first.count() == 5  # a reader keeps the version it has
    catalog = Catalog(spark, base_path=target.folder)
    assert catalog.names() == ["t"] and catalog.table("t").count() == 3
    assert catalog.query().select("id").from_table("t").where("id < 4").to_df().count() == 2
    target.write(spark.range(1), "u")
    assert catalog.names() == ["t", "u"] and catalog.table("t").count() == 3
    target.drop("u")
    assert catalog.names() == ["t"]
    with pytest.raises(ValueError, match="no table u"):
        target.read("u")


def test_old_versions_go(spark, target):
    for n in range(1, 6):
        target.write(spark.range(n), "t")
    assert len(folders(target, "t")) == 2
    assert len(os.listdir(f"{target.folder}/_versions")) <= 4  # two files and their checksums
    assert target.read("t").count() == 5


def test_a_failed_write_changes_nothing(spark, target):
    target.write(spark.range(5), "t")
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        target.write(bad, "t")
    assert target.read("t").count() == 5 and len(folders(target, "t")) == 1


def test_tables_are_replaced_together_or_not_at_all(spark, target):
    with target.together():
        target.write(spark.range(1), "a")
        target.write(spark.range(1), "b")
        assert versions.current_tables(spark, target.folder) is None
    with pytest.raises(RuntimeError, match="lost"):
        with target.together():
            target.write(spark.range(2), "a")
            assert target.read("a").count() == 1
            target.write(spark.range(2), "b")
            raise RuntimeError("the driver is lost")
    assert [target.read(t).count() for t in "ab"] == [1, 1]
    assert [len(folders(target, t)) for t in "ab"] == [1, 1]
    with target.together():
        target.write(spark.range(3), "a")
        target.write(spark.range(4), "a")
        target.write(spark.range(3), "b")
    assert [target.read(t).count() for t in "ab"] == [4, 3]


@pytest.mark.parametrize("step", ["create", "rename"])
def test_readers_never_see_a_gap(spark, target, monkeypatch, step):
    """Whatever stops a job before the pointer is in place, the old rows are there; nothing in place
    is moved or deleted before."""
    target.write(spark.range(5), "t")
    real = versions.store_of

    class Stopped:
        def __init__(self, store):
            self.store = store

        def __getattr__(self, name):
            if name == step:
                assert target_rows() == 5
                raise OSError("stopped")
            return getattr(self.store, name)

    def target_rows():
        with monkeypatch.context() as undone:
            undone.setattr(versions, "store_of", real)
            return target.read("t").count()

    with monkeypatch.context() as patched:
        patched.setattr(versions, "store_of", lambda s, p: (Stopped(real(s, p)[0]), real(s, p)[1]))
        with pytest.raises(OSError, match="stopped"):
            target.write(spark.range(9), "t")
    assert target.read("t").count() == 5
    target.write(spark.range(9), "t")
    assert target.read("t").count() == 9


def test_two_jobs_at_once(spark, target):
    other = VersionedTarget(spark, target.base, "d")
    with pytest.raises(RuntimeError, match="another job"):
        with target.together():
            target.write(spark.range(1), "a")
            other.write(spark.range(2), "a")
    assert other.read("a").count() == 2 and len(folders(target, "a")) == 1


def test_layout_and_files(spark, tmp_path):
    target = VersionedTarget(spark, str(tmp_path), "d", batch_size=10, sky_zone=30)
    stars = spark.range(100).select((F.col("id") * 3.5).alias("ra"), (F.col("id") - 50.0).alias("dec"))
    target.write(stars, "stars")
    stored = Catalog(spark, base_path=target.folder).table("stars")
    assert "sky_zone_30" in stored.columns and stored.count() == 100


def test_loads_into_versions(spark, target, monkeypatch):
    loader = Loader(entry.catalog(spark, SF_DIR), target)
    loader.load_all_datasets(limit_per_dataset=5)
    stored = Catalog(spark, base_path=target.folder)
    assert {n: stored.table(n).count() for n in stored.names()} == dict.fromkeys(stored.names(), 5)
    assert len(stored.names()) == 5

    def lost(self, limit=None):
        raise RuntimeError("lost")

    monkeypatch.setattr(Loader, "load_microlensing_data", lost)
    with pytest.raises(RuntimeError):
        loader.load_all_datasets(limit_per_dataset=7)
    assert {stored.table(n).count() for n in stored.names()} == {5}
