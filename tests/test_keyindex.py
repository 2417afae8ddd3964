"""The key index, and layers that are replaced as a whole."""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit.sources import ingest, registry
from cohortkit.sources.generations import Generations
from cohortkit.sources.keyindex import KeyIndex, index_path


def _keys(spark, lo, hi, step=1, parts=2):
    return spark.range(lo, hi, step, parts).select(F.concat(F.lit("r"), "id").alias("k"), F.col("id").alias("v"))


def _got(df):
    return sorted(r.k for r in df.collect())


def test_present_is_exact_and_follows_the_table(spark, tmp_path):
    path = f"{tmp_path}/raw/t"
    index = KeyIndex(spark, path, "k", buckets=8)
    assert index.refresh().present(_keys(spark, 0, 5)).count() == 0   # there is no table yet
    _keys(spark, 0, 3000).write.parquet(path)
    batch = _keys(spark, 2900, 3100).unionByName(_keys(spark, 2990, 3000))
    assert _got(index.refresh().present(batch)) == sorted(f"r{i}" for i in range(2900, 3000))
    first = index.folder
    # Rows that were appended without the index are taken in, from their own files only.
    _keys(spark, 3000, 3050, parts=1).write.mode("append").parquet(path)
    again = KeyIndex(spark, path, "k")
    assert _got(again.refresh().present(batch)) == sorted(f"r{i}" for i in range(2900, 3050))
    assert again.folder == first and again.buckets == 8
    assert spark.read.parquet(f"{first}/keys").count() == 3050
    # A table that was written anew gets a new index: what is gone is not present.
    _keys(spark, 0, 10).write.mode("overwrite").parquet(path)
    assert _got(KeyIndex(spark, path, "k").refresh().present(_keys(spark, 5, 50))) == [f"r{i}" for i in range(5, 10)]


def test_blocks_have_a_file_per_bucket_whatever_the_tasks(spark, tmp_path):
    path, name = f"{tmp_path}/raw/t", "spark.sql.adaptive.coalescePartitions.enabled"
    _keys(spark, 0, 3000, parts=4).write.parquet(path)
    spark.conf.set(name, "false")  # tables that are large are not joined into one task
    try:
        index = KeyIndex(spark, path, "k", buckets=2, keys_per_block=64).refresh()
    finally:
        spark.conf.set(name, "true")
    files = spark.read.parquet(f"{index.folder}/bloom").inputFiles()
    assert index.blocks > 8 and len(files) == 2
    assert _got(index.present(_keys(spark, 2990, 3010))) == sorted(f"r{i}" for i in range(2990, 3000))


def test_keys_taken_in_twice_are_named_once(spark, tmp_path):
    path = f"{tmp_path}/raw/t"
    _keys(spark, 0, 20).write.parquet(path)
    index = KeyIndex(spark, path, "k", buckets=2).refresh()
    index._take(spark.read.parquet(path), [], index.folder)
    assert _got(index.present(_keys(spark, 15, 30))) == [f"r{i}" for i in range(15, 20)]


def test_few_keys_are_in_doubt(spark, tmp_path):
    path = f"{tmp_path}/raw/t"
    _keys(spark, 0, 20_000).write.parquet(path)
    index = KeyIndex(spark, path, "k").refresh()
    assert index.doubtful(_keys(spark, 20_000, 40_000)).count() < 400
    assert index.doubtful(_keys(spark, 0, 20_000)).count() == 20_000


def test_a_full_index_is_built_anew(spark, tmp_path):
    path = f"{tmp_path}/raw/t"
    _keys(spark, 0, 40).write.parquet(path)
    small = KeyIndex(spark, path, "k", buckets=2, keys_per_block=8).refresh()
    blocks = small.blocks
    for at in (1000, 2000):
        _keys(spark, at, at + 1000).write.mode("append").parquet(path)
        small = KeyIndex(spark, path, "k", buckets=2, keys_per_block=8).refresh()
    assert small.blocks > blocks and small.present(_keys(spark, 0, 3000)).count() == 2040


def test_a_batch_in_one_bucket_reads_one_of_64(spark, tmp_path):
    path = f"{tmp_path}/raw/t"
    _keys(spark, 0, 20_000).write.parquet(path)
    index = KeyIndex(spark, path, "k").refresh()
    one = _keys(spark, 0, 40_000).where(index.bucket() == 17)
    assert index._touched(one.select(index.bucket().alias("bucket"))) == [17]
    for part in (index.stored_keys([17]), index._at("bloom", "block int, bits binary", [17])):
        scan = part._jdf.queryExecution().executedPlan()
        part.collect()
        plan = part._jdf.queryExecution().toString()
        assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
        files = {r.f for r in part.select(F.col("_metadata.file_path").alias("f")).collect()}
        assert len({f.split("bucket=")[1].split("/")[0] for f in files}) == 1, scan
    assert len([d for d in os.listdir(f"{index.folder}/keys") if d.startswith("bucket=")]) == 64
    assert _got(index.present(one)) == _got(_keys(spark, 0, 20_000).where(index.bucket() == 17))


def test_insert_ignore_with_an_index_gives_the_same_rows(spark, tmp_path):
    path = f"{tmp_path}/raw/t"
    _keys(spark, 0, 500).write.parquet(path)
    batch = (_keys(spark, 400, 700).withColumn("a", F.lit(2)).unionByName(_keys(spark, 450, 650, 2).withColumn("a", F.lit(1)))
             .unionByName(spark.sql("select cast(null as string) k, 1L v, 0 a")))
    plain = ingest.insert_ignore(batch, spark.read.parquet(path), "k", "a")
    fast = ingest.insert_ignore(batch, None, "k", "a", KeyIndex(spark, path, "k").refresh())
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, plain.collect()))


def test_the_commands_use_the_index(spark, tmp_path):
    from cohortkit import cli
    root, lines = str(tmp_path / "wh"), tmp_path / "u.json"
    lines.write_text('{"user_id": "a"}\n{"user_id": "b"}\n{"user_id": "a"}\n{"fans": 1}\n')
    assert cli.land(spark, "users", str(lines), root) == {"inserted": 2, "duplicate": 1, "rejected": 1}
    assert cli.land(spark, "users", str(lines), root) == {"inserted": 0, "duplicate": 3, "rejected": 1}
    assert cli.sync(spark, root, str(tmp_path / "copy"))["raw_users"] == 2
    assert cli.sync(spark, root, str(tmp_path / "copy"))["raw_users"] == 0
    for base in (root, str(tmp_path / "copy")):
        path = registry.raw_path(base, "raw_users")
        assert os.path.exists(index_path(path)) and registry.read_raw(spark, base, "raw_users").count() == 2


def test_a_failed_build_leaves_the_old_set(spark, tmp_path):
    root = str(tmp_path)
    old = {"a": spark.range(3), "b": spark.range(4)}
    registry.materialize(old, root)
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        registry.materialize({"a": spark.range(30), "b": broken}, root)
    now = registry.read_layer(spark, root, "marts")
    assert {n: df.count() for n, df in now.items()} == {"a": 3, "b": 4}
    held = now["a"]  # a reader that began before the next build
    paths = registry.materialize({"a": spark.range(31), "b": spark.range(41)}, root)
    assert {n: df.count() for n, df in registry.read_layer(spark, root, "marts").items()} == {"a": 31, "b": 41}
    assert held.count() == 3 and spark.read.parquet(paths["b"]).count() == 41
    # What the failed build left is gone, and no more than two generations stay.
    registry.materialize({"a": spark.range(1), "b": spark.range(1)}, root)
    assert len([n for n in os.listdir(f"{root}/marts") if n.startswith("gen-")]) == 2


def test_a_build_of_marts_killed_midway_is_not_seen(spark, tmp_path, monkeypatch):
    from cohortkit.plans.build import run_build
    from cohortkit.plans.models import Models
    from cohortkit.sources.generations import Generation
    from .conftest import SF001
    root = str(tmp_path)
    models = Models.from_fixtures(spark, SF001)
    run_build(spark, models, root, gate=False)
    before = {n: df.count() for n, df in registry.read_layer(spark, root, "marts").items()}
    whole, written = Generation.write, []

    def dies(self, table, df, partition_by=None):
        if table.startswith("fct_"):
            written.append(table)
            if len(written) == 3:
                raise KeyboardInterrupt
        return whole(self, table, df.limit(0), partition_by)

    monkeypatch.setattr(Generation, "write", dies)
    with pytest.raises(KeyboardInterrupt):
        run_build(spark, Models.from_fixtures(spark, SF001), root, gate=False)
    assert len(written) == 3
    assert {n: df.count() for n, df in registry.read_layer(spark, root, "marts").items()} == before


def test_two_builds_cannot_take_one_number(spark, tmp_path):
    home = Generations(spark, f"{tmp_path}/layer")
    a, b = home.begin(), home.begin()
    for g, n in ((a, 1), (b, 2)):
        g.write("t", spark.range(n))
    a.commit()
    with pytest.raises(Exception, match="(?i)exist"):
        b.commit()
    assert home.current() == a.folder
    with pytest.raises(FileNotFoundError):
        registry.read_layer(spark, str(tmp_path), "other")
