"""Raw tables while they are read, written by two, vacuumed; many landed files at once."""

import json
import os
import threading
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridmart.sinks import versions
from gridmart.sinks.raw import load_landed, read_raw
from gridmart.sources import build_manifest, landing_status, list_landed, year_range
from gridmart.sources.landing import fingerprints, scan_with_provenance, schema_classes

SCHEMA = "v int, source_file string"


def rows(spark, **files):
    data = [(v, key) for key, values in files.items() for v in values]
    return spark.createDataFrame(data, SCHEMA)


def shown(spark, path, **more):
    return sorted(tuple(r) for r in versions.read(spark, path, SCHEMA, **more).collect())


def test_keys_are_replaced_and_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, a=[1, 2], b=[3]), path, ["a", "b"])
    assert shown(spark, path) == [(1, "a"), (2, "a"), (3, "b")]
    versions.replace(rows(spark, a=[5]), path, ["a"], {"a": {"print": "x"}})
    versions.replace(rows(spark, a=[5]), path, ["a"], {"a": {"print": "x"}})
    assert shown(spark, path) == [(3, "b"), (5, "a")] and shown(spark, path, keys=["a"]) == [(5, "a")]
    assert versions.current(spark, path).files["a"]["print"] == "x"
    versions.replace(rows(spark), path, ["a"])
    assert shown(spark, path) == [(3, "b")]
    versions.remove(spark, path, ["b"])
    assert shown(spark, path) == [] and versions.read(spark, path, SCHEMA).columns == ["v", "source_file"]


def test_a_reader_keeps_what_it_saw(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, a=[1], b=[2]), path, ["a", "b"])
    reader = versions.read(spark, path, SCHEMA)
    versions.replace(rows(spark, a=[7, 8]), path, ["a"])
    assert sorted(r.v for r in reader.collect()) == [1, 2]
    assert shown(spark, path) == [(2, "b"), (7, "a"), (8, "a")]


def test_readers_during_reloads_see_old_or_new_rows(spark, tmp_path):
    """Every load gives all rows of a file one number; a mixture or a gap would show."""
    path = str(tmp_path / "t")
    versions.replace(rows(spark, a=[0] * 20), path, ["a"])
    seen, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            seen.append([r.v for r in versions.read(spark, path, SCHEMA).collect()])

    readers = [threading.Thread(target=look) for _ in range(2)]
    for r in readers:
        r.start()
    for k in range(1, 8):
        versions.replace(rows(spark, a=[k] * 20), path, ["a"])
    stop.set()
    for r in readers:
        r.join()
    assert len(seen) > 2 and all(len(s) == 20 and len(set(s)) == 1 for s in seen)


def test_a_load_that_fails_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, a=[1]), path, ["a"])
    bad = rows(spark, a=[2, 3]).withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="no"):
        versions.replace(bad, path, ["a"])
    assert shown(spark, path) == [(1, "a")]
    assert versions.vacuum(spark, path) == 1 and shown(spark, path) == [(1, "a")]


def test_two_writers_at_once_both_count(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, a=[1]), path, ["a"])
    calls = []

    def change(files):
        if not calls:  # someone commits between our reading and our writing
            calls.append(1)
            versions.replace(rows(spark, b=[2]), path, ["b"])
        return {k: v for k, v in files.items() if k != "a"}

    versions.commit(spark, path, change)
    assert shown(spark, path) == [(2, "b")] and versions.current(spark, path).number == 3


def test_a_pointer_that_is_being_written_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, a=[1]), path, ["a"])
    (tmp_path / "t" / "_current" / f"{2:012d}.json").write_text('{"files": {"a')
    assert shown(spark, path) == [(1, "a")]
    versions.replace(rows(spark, b=[2]), path, ["b"])
    assert shown(spark, path) == [(1, "a"), (2, "b")] and versions.current(spark, path).number == 3


def test_folders_from_before_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = "x/y z=%1.parquet"
    rows(spark, **{odd: [1], "b": [2]}).write.partitionBy("source_file").parquet(path)
    assert shown(spark, path) == sorted([(1, odd), (2, "b")])
    versions.replace(rows(spark, b=[9]), path, ["b"])
    assert shown(spark, path) == sorted([(1, odd), (9, "b")])
    versions.replace(rows(spark, **{odd: [3]}), path, [odd])
    versions.replace(rows(spark, b=[4]), path, ["b"])
    assert versions.vacuum(spark, path, keep=1) == 3 and shown(spark, path) == sorted([(3, odd), (4, "b")])
    assert json.loads(next((tmp_path / "t" / "_current").glob("*.json")).read_text())["files"].keys() == {odd, "b"}


def land(root, key, columns):
    os.makedirs(os.path.dirname(f"{root}/{key}"), exist_ok=True)
    pq.write_table(pa.table(columns), f"{root}/{key}")


def test_unchanged_files_are_left_alone(spark, tmp_path):
    root, out = str(tmp_path / "land ing+1"), str(tmp_path / "raw")
    for year in (2021, 2022, 2023):
        land(root, f"pbp/play_by_play_{year}.parquet", {"PLAY_ID": [year]})

    def load(**more):
        files = build_manifest(year_range(spark, 2021, 2023), "pbp")
        return load_landed(spark, landing_status(files, list_landed(spark, root)), root, out, **more)

    def loaded():
        found = read_raw(spark, f"{out}/RAW_PLAY_BY_PLAY").select("source_year", F.col("record").cast("string"), "loaded_at")
        return {r[0]: r[1:] for r in found.collect()}

    assert load(skip_unchanged=True) == {"RAW_PLAY_BY_PLAY": 3} and load(skip_unchanged=True) == {}
    before = loaded()
    time.sleep(0.05)
    land(root, "pbp/play_by_play_2022.parquet", {"PLAY_ID": [7]})
    assert load(skip_unchanged=True) == {"RAW_PLAY_BY_PLAY": 1}
    after = loaded()
    assert after[2021] == before[2021] and after[2023] == before[2023] and after[2022][0] == '{"PLAY_ID":7}'
    assert load() == {"RAW_PLAY_BY_PLAY": 3}


def test_many_files_are_a_few_scans(spark, tmp_path):
    root = str(tmp_path)
    keys = [f"pbp/play_by_play_{k}.parquet" for k in range(1200)]
    for k, key in enumerate(keys):
        land(root, key, {"a": [k], "b": [float(k)] if k % 3 else [k]})
    start = time.perf_counter()
    classes = schema_classes(spark, root, keys)
    entries = [dict(source_key=key, dataset="pbp", year=k) for k, key in enumerate(keys)]
    raw = scan_with_provenance(spark, root, entries, classes)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    seconds = time.perf_counter() - start
    assert sorted(len(files) for _, files in classes) == [400, 800]
    assert plan.count("FileScan") == 2 and seconds < 60
    wrong = raw.filter("source_file <> concat('pbp/play_by_play_', source_year, '.parquet')").count()
    assert raw.count() == 1200 and wrong == 0 and len(fingerprints(spark, root)) == 1200


def test_files_of_no_entry_are_an_error(spark, tmp_path):
    root = str(tmp_path)
    land(root, "pbp/play_by_play_1.parquet", {"a": [1]})
    classes = schema_classes(spark, root, ["pbp/play_by_play_1.parquet"])
    entries = [dict(source_key="pbp/other.parquet", dataset="pbp", year=1)]
    with pytest.raises(Exception, match="of no file in the manifest"):
        scan_with_provenance(spark, root, entries, classes).collect()
