import os
import shutil

import pytest
from pyspark.sql import functions as F

from plumbline.sources import fingerprint


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "a table"), str(tmp_path / "manifest")


def rows(spark, first, last):
    return spark.range(first, last, numPartitions=2).select(
        "id", F.when(F.col("id") % 7 != 0, F.col("id") / 3).alias("file"), F.concat(F.lit("x%+ "), "id").alias("file_0")
    )


def whole(spark, path):
    return fingerprint.dataset_fingerprint(spark.read.parquet(path)).first()


def files_read(spark, monkeypatch):
    """Files that a run hashes, in a list."""
    seen, sums = [], fingerprint._sums

    def noted(df, names, by=()):
        if by:
            seen.append(sorted(r[0] for r in df.select(*by).distinct().collect()))
        return sums(df, names, by)

    monkeypatch.setattr(fingerprint, "_sums", noted)
    return seen


@pytest.mark.parametrize("listed", [10_000, 0])
def test_appended_table_has_the_whole_fingerprint(spark, place, listed):
    path, manifest = place
    rows(spark, 0, 50).write.parquet(path)
    for first in (50, 90):
        assert fingerprint.table_fingerprint(spark, path, manifest, listed).first() == whole(spark, path)
        rows(spark, first, first + 40).write.mode("append").parquet(path)
    assert fingerprint.table_fingerprint(spark, path, manifest, listed).first() == whole(spark, path)


def test_only_new_files_are_read(spark, place, monkeypatch):
    path, manifest = place
    rows(spark, 0, 50).write.parquet(path)
    fingerprint.table_fingerprint(spark, path, manifest)
    seen = files_read(spark, monkeypatch)
    fingerprint.table_fingerprint(spark, path, manifest)
    assert seen == []
    rows(spark, 50, 60).coalesce(1).write.mode("append").parquet(path)
    assert fingerprint.table_fingerprint(spark, path, manifest).first() == whole(spark, path)
    assert [len(files) for files in seen] == [1]


def test_removed_and_changed_files(spark, place):
    path, manifest = place
    rows(spark, 0, 60).write.parquet(path)
    first = fingerprint.table_fingerprint(spark, path, manifest).first()
    spark.read.parquet(path).limit(5).coalesce(1).write.parquet(path + " other")
    files = [f for f in sorted(os.listdir(path)) if f.endswith(".parquet")]
    other = next(f for f in os.listdir(path + " other") if f.endswith(".parquet"))
    shutil.copy(f"{path} other/{other}", f"{path}/{files[0]}")
    crc = f"{path}/.{files[0]}.crc"
    shutil.copy(f"{path} other/.{other}.crc", crc)
    changed = fingerprint.table_fingerprint(spark, path, manifest).first()
    assert changed == whole(spark, path) and changed != first
    os.remove(f"{path}/{files[1]}")
    assert fingerprint.table_fingerprint(spark, path, manifest).first() == whole(spark, path)


def test_partitioned_empty_and_one_file(spark, place):
    path, manifest = place
    rows(spark, 0, 60).withColumn("part", F.concat(F.lit("a b%"), F.col("id") % 3)).write.partitionBy("part").parquet(path)
    fingerprint.table_fingerprint(spark, path, manifest)
    rows(spark, 60, 61).withColumn("part", F.lit("new [x]")).write.mode("append").partitionBy("part").parquet(path)
    assert fingerprint.table_fingerprint(spark, path, manifest).first() == whole(spark, path)
    rows(spark, 0, 0).write.parquet(path + " empty")
    none = fingerprint.table_fingerprint(spark, path + " empty", manifest).first()
    assert none == whole(spark, path + " empty") and none["row_total"] == 0


def test_other_columns_start_anew(spark, place):
    path, manifest = place
    rows(spark, 0, 20).write.parquet(path)
    fingerprint.table_fingerprint(spark, path, manifest)
    rows(spark, 0, 20).drop("file").write.mode("overwrite").parquet(path)
    assert fingerprint.table_fingerprint(spark, path, manifest).first() == whole(spark, path)
