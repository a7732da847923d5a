import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from stagehouse import OptionError, StagingArea
from stagehouse.sources.staging import is_below, shared_folder, stage

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registering_twice_counts_once(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path))
    path = area.new_dir()
    area.register(path)
    area.register("file:" + path)
    assert len(area) == 1 and path in area and f"file://{path}" in area


def test_release_deletes_whole_tree_and_forgives_missing(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path))
    path = area.new_dir()
    os.makedirs(os.path.join(path, "deep", "er"))
    area.release(path)
    assert not os.path.exists(path) and path not in area
    area.release(path)
    area.register(str(tmp_path / "gone"))
    area.release_all()
    assert len(area) == 0


def test_keep(spark, tmp_path):
    with StagingArea(spark, str(tmp_path)) as area:
        kept, dropped = area.new_dir(), area.new_dir()
        area.keep(kept)
    assert os.path.exists(kept) and not os.path.exists(dropped)


def test_below_compares_names_not_text(spark, tmp_path):
    assert is_below("/a/b/c", "/a/b") and is_below("file:///a/b/c", "/a/b")
    assert not is_below("/a/bc", "/a/b")
    assert not is_below("/a/b", "/a/b")
    assert not is_below("hdfs://n/a/b/c", "/a/b")
    area = StagingArea(spark, str(tmp_path))
    path = area.new_dir()
    assert area.covers(path + "/x") and not area.covers(path) and not area.covers(path + "x")


def test_one_failing_path_does_not_stop_the_rest(spark, tmp_path, monkeypatch):
    area = StagingArea(spark, str(tmp_path))
    paths = sorted(area.new_dir() for _ in range(3))
    release = area.release

    def failing(path):
        if path == paths[0]:
            raise OSError("no")
        release(path)

    monkeypatch.setattr(area, "release", failing)
    area.release_all()
    assert [os.path.exists(p) for p in paths] == [True, False, False]
    assert list(area) == [paths[0]]


def test_stage_counts_rows_in_the_same_job(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path))
    staged = stage(spark.range(1000), area)
    assert staged.rows == 1000 and staged.scan().count() == 1000
    assert staged.path in area and os.path.basename(staged.path).startswith("run_")


@pytest.mark.parametrize("empty", ["where false", "limit 0"])
def test_empty_frames_stage(spark, tmp_path, empty):
    area = StagingArea(spark, str(tmp_path))
    staged = stage(spark.sql(f"select id, cast(id as string) as s from range(5) {empty}"), area)
    assert staged.rows == 0 and staged.scan().dtypes == [("id", "bigint"), ("s", "string")]


def test_failed_stage_leaves_nothing(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path))
    bad = spark.range(10).select(F.raise_error(F.lit("no")).alias("x"), "id")
    with pytest.raises(Exception, match="no"):
        stage(bad.select("id", F.col("x").cast("string")), area)
    assert len(area) == 0 and os.listdir(tmp_path) == []


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_shared_folder_is_an_error():
    class Session:
        class conf:
            @staticmethod
            def get(_key, default):
                return default

    with pytest.raises(OptionError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_directories_are_gone_after_exit(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from stagehouse import CatalogWarehouse
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
w = CatalogWarehouse(spark, {str(tmp_path / "t")!r}, {str(tmp_path / "s")!r}, locations={{"l": {str(tmp_path / "l")!r}}})
spark.range(5).createOrReplaceTempView("v")
w.read(table="v"); w.read(table="v", location="l"); kept = w.unload("v", location="l")
w.write(spark.range(5), "t"); w.write(spark.range(6), "t", mode="overwrite")
import os; print(len([n for n in os.listdir({str(tmp_path / "s")!r}) if not n.endswith((".lease", ".crc"))]), len(os.listdir({str(tmp_path / "l")!r})), len(os.listdir({str(tmp_path / "t" / "t")!r})))
"""
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=tmp_path
    )
    assert done.stdout.split() == ["1", "2", "2"], done.stderr[-2000:]
    assert os.listdir(tmp_path / "s") == []
    assert len(os.listdir(tmp_path / "l")) == 1
    assert len(os.listdir(tmp_path / "t" / "t")) == 1


def test_expired_directories_go_and_live_ones_stay(spark, tmp_path):
    base = str(tmp_path / "area")
    dead, live = StagingArea(spark, base, lease_hours=-1), StagingArea(spark, base)
    lost = stage(spark.range(3), dead)  # its process is killed: nobody releases it
    held = stage(spark.range(4), live)
    kept = dead.new_dir()
    dead.keep(kept)
    (tmp_path / "area" / "run_of_somebody").mkdir()
    later = StagingArea(spark, base)
    left = {p.name for p in (tmp_path / "area").iterdir() if not p.name.startswith(".")}
    names = {held.path.rsplit("/", 1)[1], kept.rsplit("/", 1)[1], "run_of_somebody"}
    assert left == names | {held.path.rsplit("/", 1)[1] + ".lease"}
    assert lost.path.rsplit("/", 1)[1] not in left and held.scan().count() == 4
    assert later.sweep() == [] and len(later) == 0


def test_leases_are_renewed_and_end_with_the_directory(spark, tmp_path):
    base = str(tmp_path / "area")
    area = StagingArea(spark, base, lease_hours=-1)
    staged = stage(spark.range(3), area)
    area.lease_hours = 1
    area.renew()
    assert StagingArea(spark, base).sweep() == [] and staged.scan().count() == 3
    area.release(staged.path)
    assert [p for p in (tmp_path / "area").iterdir() if not p.name.startswith(".")] == []
    assert area.covers(f"{base}/x") is False
    area.register(base)
    assert area.covers(f"{base}/x/y") and not area.covers(base)


def test_a_killed_process_leaves_what_the_next_one_sweeps(spark, tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    base = str(tmp_path / "area")
    code = f"""
import os, sys
sys.path.insert(0, {str(Path(__file__).parents[1])!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from stagehouse.sources.staging import StagingArea, stage
stage(spark.range(5), StagingArea(spark, {base!r}, lease_hours=1 / 3600))
pid = spark._jvm.java.lang.ProcessHandle.current().pid()
os.kill(pid, 9)
os._exit(9)
"""
    assert subprocess.run([sys.executable, "-c", code], timeout=120).returncode == 9
    import time

    assert [p for p in (tmp_path / "area").iterdir() if p.is_dir()]
    time.sleep(1.5)
    assert len(StagingArea(spark, base).sweep()) in (0, 1)
    assert not [p for p in (tmp_path / "area").iterdir() if p.is_dir()]
