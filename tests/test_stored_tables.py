"""Upsert and insert on stored files: the rows of the plain operators, at the cost of the patch."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from voxlens.operators import buckets, id_index, sinks

KEYS = ["k", "part"]
SCHEMA = "k string, part string, v long, note string"


def scores(spark, lo, hi, v, note="n"):
    return spark.createDataFrame([(f"a{i}", None if i % 10 == 3 else f"p{i % 3}", v + i, note) for i in range(lo, hi)], SCHEMA)


def data_folders(base):
    found = set()
    for top, _, names in os.walk(f"{base}/t/_data"):
        if any(n.endswith(".parquet") for n in names):
            found.add(top)
    return found


@pytest.fixture()
def base():
    return tempfile.mkdtemp(prefix="voxlens-buckets-")


def test_a_patch_of_one_key_writes_one_bucket(spark, base):
    buckets.write(scores(spark, 0, 200, 0), base, "t", "s0", KEYS, n_buckets=16)
    before = data_folders(base)
    assert len(before) == 16
    patch = spark.createDataFrame([("a7", "p1", -1, "new")], SCHEMA)
    assert len(buckets.upsert(patch, base, "t", "s0", "s1", ["v"])) == 1
    assert len(data_folders(base) - before) == 1
    want = sinks.upsert(scores(spark, 0, 200, 0), patch, KEYS, ["v"])
    assert sorted(map(str, buckets.read(spark, base, "t", "s1").collect())) == sorted(map(str, want.select(*SCHEMA_COLS).collect()))
    assert buckets.read(spark, base, "t", "s0").where("v = -1").count() == 0  # the old snapshot stays as it was
    touched = {r.path for r in buckets.manifest(spark, base, "t", "s1").collect()} - {
        r.path for r in buckets.manifest(spark, base, "t", "s0").collect()}
    assert len(touched) == 1


SCHEMA_COLS = [c.split()[0] for c in SCHEMA.split(", ")]


@pytest.mark.parametrize("n_buckets", [1, 7, 64])
def test_chains_of_upserts_equal_the_plain_operator(spark, base, n_buckets):
    plain = scores(spark, 0, 60, 0)
    buckets.write(plain, base, "t", "s0", KEYS, n_buckets)
    patches = [scores(spark, 40, 90, 1000, None), scores(spark, 85, 88, 7).union(scores(spark, 85, 88, 9)), scores(spark, 0, 0, 0),
               scores(spark, 200, 201, 5)]
    for k, patch in enumerate(patches, 1):
        plain = sinks.upsert(plain, patch, KEYS, ["v", "note"])
        buckets.upsert(patch, base, "t", f"s{k - 1}", f"s{k}", ["v", "note"])
        got = buckets.read(spark, base, "t", f"s{k}").select(*SCHEMA_COLS)
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(*SCHEMA_COLS).collect()))
    counts = buckets.manifest(spark, base, "t", "s4").agg(F.sum("rows")).first()[0]
    assert counts == plain.count()


def test_an_empty_table_and_a_taken_name(spark, base):
    buckets.write(scores(spark, 0, 0, 0), base, "t", "s0", KEYS)
    assert buckets.read(spark, base, "t", "s0").columns == SCHEMA_COLS and buckets.read(spark, base, "t", "s0").count() == 0
    buckets.upsert(scores(spark, 0, 5, 0), base, "t", "s0", "s1", ["v"])
    assert buckets.read(spark, base, "t", "s1").count() == 5
    with pytest.raises(FileExistsError):
        buckets.upsert(scores(spark, 5, 9, 0), base, "t", "s0", "s1", ["v"])
    assert buckets.read(spark, base, "t", "s1").count() == 5


# S4


def feedback(spark, ids, day="2024-01-01"):
    return spark.createDataFrame([(i, f"{day} 00:00:00", "x") for i in ids], "id string, created_at string, summary string")


def stored(spark, path):
    return sorted(str(r.id) for r in spark.read.parquet(path).select("id").collect())


def test_the_probe_opens_only_files_that_may_conflict(spark):
    path = tempfile.mkdtemp(prefix="voxlens-index-") + "/t"
    for b in range(4):
        id_index.insert(feedback(spark, [f"b{b}-{k}" for k in range(200)]), path, b)
    all_files = set(spark.read.parquet(path).inputFiles())
    ids = feedback(spark, ["b2-7", "b2-8", "new"]).select("id")
    opened = id_index.candidate_files(ids, path)
    assert 1 <= len(opened) <= 2 < len(all_files) and all("batch_id=2" in f for f in opened)
    assert id_index.candidate_files(feedback(spark, ["new", None]).select("id"), path) == []
    assert sorted(r.id for r in id_index.conflicts(ids, path).collect()) == ["b2-7", "b2-8"]
    id_index.insert(feedback(spark, ["b2-7", "new", "new", None, None, "b0-0"]), path, 4)
    assert sorted(str(r.id) for r in spark.read.parquet(f"{path}/batch_id=4").collect()) == ["None", "None", "new"]


def test_false_positives_change_nothing(spark, monkeypatch):
    """Fingerprints that nearly all ids share."""
    monkeypatch.setattr(id_index, "fingerprint", lambda c: F.pmod(F.xxhash64(c), F.lit(3)))
    path = tempfile.mkdtemp(prefix="voxlens-false-") + "/t"
    id_index.insert(feedback(spark, [f"x{k}" for k in range(50)]), path, 0)
    assert id_index.candidate_files(feedback(spark, [f"y{k}" for k in range(20)]).select("id"), path)
    id_index.insert(feedback(spark, [f"x{k}" for k in range(40, 60)]), path, 1)
    assert stored(spark, path) == sorted(f"x{k}" for k in range(60))


def test_replays_and_batches_without_an_index(spark):
    path = tempfile.mkdtemp(prefix="voxlens-replay-") + "/t"
    id_index.insert(feedback(spark, ["a", "b"]), path, 0)
    for _ in range(2):
        id_index.insert(feedback(spark, ["b", "c"]), path, 1)
    assert stored(spark, path) == ["a", "b", "c"]
    feedback(spark, ["d", "e"]).write.parquet(f"{path}/batch_id=2")  # by another writer, no index
    id_index.insert(feedback(spark, ["e", "f", "a"]), path, 3)
    assert stored(spark, path) == ["a", "b", "c", "d", "e", "f"]
    id_index.insert(feedback(spark, []), path, 4)
    id_index.insert(feedback(spark, ["f", "g"]), path, 5)
    assert stored(spark, path) == ["a", "b", "c", "d", "e", "f", "g"]
