"""Stored versions, and keys that differ between two copies."""

import random
import re

import pytest

from tidemark.operators import history
from tidemark.sinks import checksum_tree
from tidemark.sinks.version_store import VersionStore

CHANGES = "k long, v string, op string"


@pytest.fixture
def store(spark, tmp_path):
    return VersionStore(spark, str(tmp_path / "t"), spark.createDataFrame([], "k long, v string").schema, ["k"], every=3)


def test_every_version_equals_the_whole_log(spark, store, rows):
    rng, log = random.Random(1), []
    for version in range(8):
        keys = rng.sample([None, 1, 2, 3, 4], 3)
        changes = [(k, f"{version}", rng.choice("UUD")) for k in keys]
        store.commit(spark.createDataFrame(changes, CHANGES), version)
        log += [(k, v, version, op) for k, v, op in changes]
    assert store.states() == [2, 5]
    whole = spark.createDataFrame(log, "k long, v string, version long, op string")
    for version in range(9):
        assert rows(store.read(version).select("k", "v", "version")) == rows(history.as_of(whole, ["k"], version).select("k", "v", "version"))
    store.rollback(3, 8)
    assert rows(store.read(8).select("k", "v")) == rows(store.read(3).select("k", "v"))
    assert rows(store.diff(1, 4, ["v"])) == rows(history.diff_versions(
        *[store.read(n).where("k IS NOT NULL") for n in (1, 4)], ["k"], ["v"]).where("change <> 'shared'"))


def test_reading_goes_over_a_state_and_less_than_every_folder(spark, store):
    for version in range(8):
        store.commit(spark.createDataFrame([(version, "x", "U")], CHANGES), version)
    read = {re.search(r"(_version|_upto)=(\d+)", f)[0] for f in store.read(7).inputFiles()}
    assert read == {"_upto=5", "_version=6", "_version=7"}
    assert {re.search(r"_version=\d+", f)[0] for f in store.changes(2, 4).inputFiles()} == {"_version=3", "_version=4"}


def test_a_commit_that_died_or_is_repeated(spark, store, tmp_path, rows):
    for version in range(3):
        store.commit(spark.createDataFrame([(version, "x", "U")], CHANGES), version)
    (tmp_path / "t" / "log" / "_version=2" / "_SUCCESS").unlink()
    assert store.versions() == [0, 1]
    store.commit(spark.createDataFrame([(2, "again", "U")], CHANGES), 2)
    assert (store.states(), rows(store.read(2))) == ([2], [(0, "x", 0), (1, "x", 1), (2, "again", 2)])
    store.commit(spark.createDataFrame([(2, "third", "U")], CHANGES), 2)
    assert rows(store.read(2))[2] == (2, "third", 2)
    with pytest.raises(ValueError):
        store.commit(spark.createDataFrame([(2, "x", "U")], CHANGES), 1)
    with pytest.raises(Exception, match="two changes"):
        store.commit(spark.createDataFrame([(2, "x", "U"), (2, "y", "U")], CHANGES), 3)
    assert store.versions() == [0, 1, 2] and rows(store.read(-1)) == []


def copies(spark, tmp_path, before, after, schema="k long, a long, b long"):
    paths = [str(tmp_path / name) for name in ("before", "after")]
    for data, path in zip((before, after), paths):
        checksum_tree.write(spark.createDataFrame(data, schema), ["k"], path, folder_bits=4)
    return paths


def test_keys_that_differ(spark, tmp_path, rows):
    before = [(k, k, None) for k in range(500)] + [(None, 1, 1), (7, 8, 9), (600, 1, 2)]
    after = [(k, k, None) for k in range(1, 500) if k != 9] + [(9, None, 9), (None, 1, 2), (7, 8, 9), (7, 8, 9), (600, 1, 2), (700, 0, 0)]
    found = checksum_tree.changed_keys(spark, *copies(spark, tmp_path, before, after), ["k"], folder_bits=4)
    assert rows(found) == sorted([(0, "removed"), (9, "changed"), (None, "changed"), (7, "changed"), (700, "added")], key=str)


def test_only_ranges_that_differ_are_read(spark, tmp_path, rows):
    before = [(k, k, k) for k in range(2000)]
    after = [(k, k, k + (k == 77)) for k in reversed(range(2000))]
    found = checksum_tree.changed_keys(spark, *copies(spark, tmp_path, before, after), ["k"], folder_bits=4)
    assert rows(found) == [(77, "changed")]
    scans = re.findall(r"PartitionFilters: \[(.*?)\]", found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    named = {m for s in scans for m in re.findall(r"_range#\d+ = (\d+)", s)}
    assert len(named) == 1, scans


@pytest.mark.parametrize("data", [[], [(1, None, 2), (1, None, 2)]])
def test_equal_copies(spark, tmp_path, rows, data):
    paths = copies(spark, tmp_path, data, data)
    assert rows(checksum_tree.changed_keys(spark, *paths, ["k"], folder_bits=4)) == []
    assert checksum_tree.differing_leaves(spark, *paths).count() == 0
