"""Tables that are replaced at once."""

import pytest
from pyspark.errors import AnalysisException

from hirelake.operators import versions
from hirelake.session import folders_in


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_old_or_new_rows(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert versions.current_version(spark, path) == 0
    with pytest.raises(AnalysisException):
        versions.read_version(spark, path)
    assert versions.publish(spark, spark.range(5), path) == 1
    old = versions.read_version(spark, path)
    # A table may be made from itself.
    assert versions.publish(spark, versions.read_version(spark, path).selectExpr("id + 100 AS id"), path) == 2
    assert numbers(old) == [0, 1, 2, 3, 4]
    assert numbers(versions.read_version(spark, path)) == [100, 101, 102, 103, 104]
    assert numbers(versions.read_version(spark, path, 1)) == numbers(old)


def test_a_reader_during_a_load(spark, tmp_path, monkeypatch):
    path, seen = f"{tmp_path}/table", []
    versions.publish(spark, spark.range(3), path)
    rename = versions.rename_path

    def watched(session, source, target):
        seen.append(numbers(versions.read_version(session, path)))  # all is written, nothing is named yet
        rename(session, source, target)
        seen.append(numbers(versions.read_version(session, path)))

    monkeypatch.setattr(versions, "rename_path", watched)
    versions.publish(spark, spark.range(7, 9), path)
    assert seen == [[0, 1, 2], [7, 8]]


def test_a_load_that_fails_changes_no_table(spark, tmp_path):
    first, second = f"{tmp_path}/first", f"{tmp_path}/second"
    versions.publish_all(spark, {first: spark.range(2), second: spark.range(2)})
    broken = spark.range(2).selectExpr("raise_error('lost') AS id")
    with pytest.raises(Exception, match="lost"):
        versions.publish_all(spark, {first: spark.range(9), second: broken})
    for path in (first, second):
        assert versions.versions(spark, path) == [1] and numbers(versions.read_version(spark, path)) == [0, 1]
    assert versions.vacuum(spark, first) >= 1  # what the lost load had written
    assert numbers(versions.read_version(spark, first)) == [0, 1]


def test_of_two_writers_one_is_told(spark, tmp_path):
    path = f"{tmp_path}/table"
    base = versions.publish(spark, spark.range(1), path)
    versions.publish(spark, spark.range(2), path, expected=base)
    with pytest.raises(versions.Conflict):
        versions.publish(spark, spark.range(3), path, expected=base)
    assert numbers(versions.read_version(spark, path)) == [0, 1]
    assert versions.publish(spark, spark.range(3), path) == base + 2


def test_vacuum_keeps_the_newest(spark, tmp_path):
    path = f"{tmp_path}/table"
    for n in range(1, 5):
        versions.publish(spark, spark.range(n), path)
    assert versions.vacuum(spark, path, keep=2) == 2
    assert versions.versions(spark, path) == [3, 4] and len(folders_in(spark, f"{path}/data")) == 2
    assert numbers(versions.read_version(spark, path, 3)) == [0, 1, 2]
    with pytest.raises(AnalysisException):
        versions.read_version(spark, path, 1)


def test_empty_and_partitioned_tables(spark, tmp_path):
    path = f"{tmp_path}/table"
    versions.publish(spark, spark.range(0), path)
    assert versions.read_version(spark, path).count() == 0
    versions.publish(spark, spark.range(6).selectExpr("id", "id % 2 AS part"), path, partition="part")
    assert numbers(versions.read_version(spark, path).where("part = 1")) == [1, 3, 5]
