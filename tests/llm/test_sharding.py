"""Shards: exact round trips, tiers and atomic versions."""

import pytest

from terravane.llm import sharding


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_round_trip_and_versions(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "SMALLEST", 1)
    store = sharding.Store(spark, f"file://{tmp_path}/store", target=200_000, fan_in=3)
    assert store.versions() == [] and store.manifest() == (0, [])
    parts = documents.randomSplit([1.0] * 7, seed=1)
    for p in parts:
        store.append(p)
    before = store.manifest()[1]
    assert store.versions() == list(range(1, 8)) and len(before) == 7
    version = store.compact(documents.schema)
    after = store.manifest()[1]
    assert version > 7 and len(after) < 7 and not store.runs(after)
    assert rows_of(store.read()) == rows_of(documents) == rows_of(store.read(7))
    store.vacuum()
    assert rows_of(store.read()) == rows_of(documents)


def test_one_writer_wins(spark, documents, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/store")
    store.append(documents)
    version, shards = store.manifest()
    store.commit(version, shards)
    with pytest.raises(FileExistsError):
        store.commit(version, [])
    assert store.manifest() == (version + 1, shards)


def test_arrivals_in_one_pass(spark, documents, empty, tmp_path):
    from pyspark.sql import functions as F

    store = sharding.Store(spark, f"file://{tmp_path}/store")
    store.append_by(documents, F.pmod(F.col("doc_id"), F.lit(5)))
    assert len(store.manifest()[1]) == 5
    store.compact(documents.schema)
    store.vacuum()
    assert rows_of(store.read(schema=documents.schema)) == rows_of(documents)
    none = sharding.Store(spark, f"file://{tmp_path}/none")
    none.append(empty)
    none.compact(empty.schema)
    assert none.read(schema=empty.schema).count() == 0


def test_large_arrivals_are_merged_into_target_sized_files(spark, documents, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "SMALLEST", 1)
    whole = sharding.Store(spark, f"file://{tmp_path}/whole")
    whole.append(documents.coalesce(1))
    size = whole.manifest()[1][0].size
    # Two arrivals of many files, each larger than the target; and one below it with nothing to go with.
    for target, arrivals in ((size // 8, 2), (size * 2, 1)):
        store = sharding.Store(spark, f"file://{tmp_path}/store-{arrivals}", target=target)
        store.append_by(documents.repartition(40), F.pmod(F.col("doc_id"), F.lit(arrivals)))
        before = store.manifest()[1]
        assert all((s.size >= target) == (arrivals == 2) for s in before)
        store.compact(documents.schema)
        store.vacuum()
        after = store.manifest()[1]
        files = store.read(schema=documents.schema).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n")).distinct().collect()
        assert not store.runs(after) and len(files) <= max(1, sum(round(s.size / target) for s in before))
        assert sum(f["n"] for f in files) / len(files) >= min(target, sum(s.size for s in after)) / 2
        assert rows_of(store.read(schema=documents.schema)) == rows_of(documents)


def test_a_second_writer_takes_the_next_version(spark, tmp_path):
    df = spark.range(5)
    a, b = (sharding.Store(spark, str(tmp_path / "s")) for _ in range(2))
    real = a.commit

    def late(base, shards):
        if base == 0:
            b.append(df)
        return real(base, shards)

    a.commit = late
    assert a.append(df) == 2
    assert a.read().count() == 10


def test_vacuum_spares_what_is_not_committed_yet(spark, tmp_path):
    store = sharding.Store(spark, str(tmp_path / "s"))
    store.append(spark.range(3))
    store._write(spark.range(4), "pending")
    store.vacuum()
    version, shards = store.manifest()
    store.commit(version, [*shards, store._shard("pending")])
    assert store.read().count() == 7
    store._write(spark.range(4), "left")
    store.vacuum(spared=0)
    assert "left" not in store._names(f"{store.root}/shards") and store.read().count() == 7


def test_compactions_that_meet_double_nothing(spark, tmp_path, monkeypatch):
    """Another store compacts between the plan of a step and its commit."""
    monkeypatch.setattr(sharding, "SMALLEST", 1)
    a, b = (sharding.Store(spark, str(tmp_path / "s"), fan_in=2) for _ in range(2))
    for i in range(4):
        a.append(spark.range(i, i + 1).coalesce(1))
    real, met = a._write, []

    def late(df, name):
        real(df, name)
        if not met:
            met.append(b.compact())

    a._write = late
    a.compact()
    assert met and rows_of(a.read()) == rows_of(spark.range(4))
    named = {s.name for s in a.manifest()[1]}
    a.vacuum(spared=0)
    assert set(a._names(f"{a.root}/shards")) == named


def test_a_step_whose_shards_are_gone_is_not_committed(spark, tmp_path):
    store = sharding.Store(spark, str(tmp_path / "s"))
    store.append(spark.range(3))
    version, shards = store.manifest()
    assert store._put([sharding.Shard("new", 1, False)], {"absent"}) is None
    assert store.manifest() == (version, shards)


def test_two_writers_and_two_compactions_at_once(spark, tmp_path, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    monkeypatch.setattr(sharding, "SMALLEST", 1)
    stores = [sharding.Store(spark, str(tmp_path / "s"), fan_in=2) for _ in range(4)]
    stores[0].append(spark.range(100, 101).coalesce(1))

    def write(store, start):
        for i in range(5):
            store.append(spark.range(start + i, start + i + 1).coalesce(1))

    def compact(store):
        for _ in range(3):
            store.compact()

    with ThreadPoolExecutor(4) as pool:
        for f in [pool.submit(write, stores[0], 0), pool.submit(write, stores[1], 5), pool.submit(compact, stores[2]), pool.submit(compact, stores[3])]:
            f.result()
    assert sorted(r["id"] for r in stores[0].read().collect()) == [*range(10), 100]


def test_other_failures_of_a_commit_are_not_taken_for_a_second_writer(spark, tmp_path):
    from py4j.protocol import Py4JJavaError

    store = sharding.Store(spark, str(tmp_path / "s"))
    store.append(spark.range(1))
    (tmp_path / "s/manifests/v00000002.json").mkdir()
    (tmp_path / "s/manifests/v00000002.json/inside").write_text("x")
    with pytest.raises((FileExistsError, Py4JJavaError)):
        store.commit(1, [])
    assert not [n for n in store._names(f"{store.root}/manifests") if n.startswith(".") and not n.endswith(".crc")]


def test_the_folder_column_is_refused(spark, tmp_path):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError):
        sharding.Store(spark, str(tmp_path / "s")).append_by(spark.range(2).withColumn("__terravane_arrival", F.lit(1)), F.lit(1))
