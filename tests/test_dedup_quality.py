import datetime as dt

from pyspark.sql import functions as F

from basketlens.operators import dedup, quality
from helpers import plan_of, rows

DAY = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def versions(spark):
    return spark.createDataFrame(
        [
            ("a", 1, DAY[0]),
            ("a", 2, DAY[3]),
            ("b", 3, DAY[3]),
            ("b", 4, DAY[3]),
            ("b", None, DAY[3]),
            ("gone", 5, DAY[1]),
            (None, 6, DAY[3]),
        ],
        "id string, n int, load_date timestamp",
    )


def test_latest_by_key(spark):
    found = dedup.latest_by_key(versions(spark), ["id"])
    assert rows(found, "id", "n") == sorted([("a", 2), ("b", 4), ("gone", 5), (None, 6)], key=repr)
    assert found.columns == ["id", "n", "load_date"]


def test_latest_by_key_does_not_depend_on_row_order(spark):
    up = dedup.latest_by_key(versions(spark).orderBy("n"), ["id"])
    down = dedup.latest_by_key(versions(spark).orderBy(F.desc("n")), ["id"])
    assert rows(up) == rows(down)


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    versions(spark).write.parquet(path)
    plan = plan_of(dedup.latest_by_key(spark.read.parquet(path), ["id"]))
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_snapshot_then_versions(spark):
    snapshot = dedup.latest_snapshot(versions(spark))
    assert snapshot.count() == 5
    assert rows(dedup.current_rows(versions(spark), ["id"]), "id", "n") == sorted(
        [("a", 2), ("b", 4), (None, 6)], key=repr
    )


def test_current_rows_of_a_view_come_from_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    versions(spark).unionByName(versions(spark).withColumn("load_date", F.lit(None).cast("timestamp"))).write.parquet(path)
    source = spark.read.parquet(path)
    found = dedup.current_rows_once(source.withColumn("m", F.col("n") + 1), ["id"], ["id", "m"])
    assert found.columns == ["id", "m"]
    assert rows(found) == rows(dedup.current_rows(source, ["id"]).select("id", (F.col("n") + 1).alias("m")))
    assert not [f for f in found.inputFiles() if path in f] and path not in plan_of(found)
    assert dedup.current_rows_once(versions(spark).limit(0), ["id"], ["n"]).count() == 0


def test_versions_are_sorted_by_a_number_first(spark):
    plan = plan_of(dedup.latest_by_key(versions(spark), ["id"]), "simple")
    assert plan.count("Sort [_w") == 2 and "xxhash64(id" in plan


def test_snapshot_of_an_empty_table(spark):
    assert dedup.latest_snapshot(versions(spark).limit(0)).count() == 0


def test_snapshot_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    versions(spark).write.parquet(path)
    plan = plan_of(dedup.latest_snapshot(spark.read.parquet(path)).select("id"))
    assert "PushedFilters: [IsNotNull(load_date), EqualTo(load_date,ScalarSubquery" in plan
    assert "ReadSchema: struct<load_date:timestamp>" in plan
    assert "ReadSchema: struct<id:string,load_date:timestamp>" in plan


def test_retention(spark, tmp_path):
    as_of = dt.date(2025, 1, 3)
    assert rows(dedup.retained(versions(spark), as_of), "n") == sorted([(2,), (3,), (4,), (None,), (6,)], key=repr)
    path = str(tmp_path / "t")
    versions(spark).write.parquet(path)
    assert "GreaterThan(load_date,2024-01-03" in plan_of(dedup.retained(spark.read.parquet(path), as_of))


def test_duplicates(spark):
    assert rows(quality.duplicate_keys(versions(spark), ["id"])) == [("a", 2), ("b", 3)]
    assert rows(quality.duplicate_summary(versions(spark), ["id"])) == [(2, 3)]
    assert rows(quality.duplicate_summary(versions(spark).limit(0), ["id"])) == [(0, 0)]


def test_load_counts(spark):
    df = versions(spark)
    assert rows(quality.load_counts({"full": df, "empty": df.limit(0)})) == [("empty", 0), ("full", 7)]


def test_rejects_name_every_failed_rule(spark):
    rules = {"id": F.col("id").isNotNull(), "n": F.coalesce(F.col("n") > 3, F.lit(False))}
    found = quality.rejected(versions(spark), rules).select("n", F.array_join("failed_rules", ","))
    assert rows(found) == sorted([(1, "n"), (2, "n"), (3, "n"), (None, "n"), (6, "id")], key=repr)
    assert quality.accepted(versions(spark), rules).count() == 2
