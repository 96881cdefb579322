"""Keyed tables, rewriting of months, routed batches, counts while writing, scratch folders."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.config import FeatureConfig, MaskingConfig
from basketlens.files import Files
from basketlens.operators import marts, quality
from basketlens.operators.dedup import latest_by_key
from basketlens.operators.flatten import json_to_raw
from basketlens.plans.publish import publish
from basketlens.plans.report import publish_report, report
from basketlens.session import scratch_path, scratch_scope, staged
from basketlens.sinks import retention
from basketlens.sinks.state import KeyedTable
from basketlens.sinks.tables import write_monthly
from basketlens.sources import tables
from basketlens.sources.documents import scan_files
from basketlens.sources.topics import FileTopics, KafkaTopics
from basketlens.streaming import ingest as streaming
from basketlens.streaming.batches import followed
from basketlens.streaming.ingest import Lake, append_batches, current_addresses, fill_marts, ingest_batch, start
from helpers import plan_of, rows
from test_movement import DOCUMENTS, LOADED, messages, product_message

SCHEMA = "k string, n int, load_date timestamp"


def newest(path, buckets=8):
    return KeyedTable(path, SCHEMA, ("k",), lambda df: latest_by_key(df, ["k"]), buckets)


def load(spark, values, day):
    return spark.createDataFrame([(k, n, dt.datetime(2024, 5, day)) for k, n in values], SCHEMA)


def test_loads_rewrite_the_buckets_they_touch(spark, tmp_path):
    table = newest(str(tmp_path / "t"))
    assert table.read(spark).count() == 0 and table.lookup(load(spark, [("a", 1)], 1)).count() == 0
    first = table.upsert(load(spark, [(f"k{i}", i) for i in range(100)], 1), {"s": 0})
    assert first == list(range(8))
    again = table.upsert(load(spark, [("k1", 1000), ("new", 5)], 2), {"s": 1})
    assert len(again) <= 2
    found = dict(rows(table.read(spark), "k", "n"))
    assert found == {f"k{i}": i for i in range(100)} | {"k1": 1000, "new": 5}
    # an older row changes nothing; a load that comes again is passed over
    table.upsert(load(spark, [("k1", -1)], 1), {"s": 2})
    assert table.upsert(load(spark, [("k1", 7)], 9), {"s": 1}) == []
    assert dict(rows(table.read(spark), "k", "n")) == found
    with pytest.raises(ValueError, match="8 buckets"):
        newest(str(tmp_path / "t"), 4).read(spark)


def test_look_ups_read_the_buckets_of_their_keys(spark, tmp_path):
    table = newest(str(tmp_path / "t"))
    table.upsert(load(spark, [(f"k{i}", i) for i in range(100)], 1))
    table.upsert(load(spark, [("k5", 50)], 2))
    found = table.lookup(load(spark, [("k5", 0), ("k5", 1), ("none", 0)], 1))
    assert rows(found, "k", "n") == [("k5", 50)]
    files = table.lookup(load(spark, [("k5", 0)], 1)).select("k").inputFiles()
    assert files and all("generation=2/" in f for f in files if "/t/" in f)


def test_a_lost_load_has_no_effect_and_runs_again(spark, tmp_path, monkeypatch):
    table = newest(str(tmp_path / "t"))
    table.upsert(load(spark, [("a", 1), ("b", 2)], 1), {"s": 0})
    with monkeypatch.context() as m:
        m.setattr(Files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            table.upsert(load(spark, [("a", 10), ("c", 3)], 2), {"s": 1})
    assert dict(rows(table.read(spark), "k", "n")) == {"a": 1, "b": 2}
    table.upsert(load(spark, [("a", 10), ("c", 3)], 2), {"s": 1})
    assert dict(rows(table.read(spark), "k", "n")) == {"a": 10, "b": 2, "c": 3}
    with pytest.raises(OSError):  # another writer has committed the same number
        table._commit(spark, table.manifest(spark))


def test_old_generations_go(spark, tmp_path):
    table = newest(str(tmp_path / "t"))
    for day in range(1, 6):
        table.upsert(load(spark, [("a", day), (f"x{day}", day)], day))
    kept = rows(table.read(spark))
    assert table.vacuum(spark, keep=1) and rows(table.read(spark)) == kept
    in_force = {f"generation={g}/bucket={b}" for b, g in table.manifest(spark).in_force.items()}
    left = {str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("generation=*/bucket=*")}
    assert left == in_force and table.vacuum(spark, keep=1) == []


def test_counts_of_loads_add_up_once(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k string, copies bigint", ("k",), lambda df: quality.merged_counts(df, ["k"]), 4)
    for number, values in ((0, "aab"), (1, "bc"), (0, "aab"), (1, "bc")):
        counts = quality.key_counts(spark.createDataFrame([(v,) for v in values], "k string"), ["k"])
        table.upsert(counts, {"loads": number})
    assert rows(table.read(spark)) == [("a", 2), ("b", 2), ("c", 1)]


DAYS = [LOADED, dt.datetime(2023, 5, 20), dt.datetime(2023, 5, 2), dt.datetime(2023, 5, 1), dt.datetime(2023, 4, 1), None]


def monthly(spark, path):
    write_monthly(spark.createDataFrame(list(enumerate(DAYS)), "id int, load_date timestamp"), path, "id")
    return lambda: rows(tables.read_monthly(spark, path, "id int, load_date timestamp"), "id")


@pytest.mark.parametrize("lost_at", [None, "written", "moved", "put"])
def test_the_boundary_month_is_rewritten_whatever_is_lost(spark, tmp_path, monkeypatch, lost_at):
    path = str(tmp_path / "t")
    left = monthly(spark, path)
    day = dt.date(2024, 5, 2)
    retention.expire(spark, path, day)
    if lost_at:
        calls = []

        def lose(step, original):
            def run(*args):
                calls.append(step)
                if step == lost_at:
                    raise OSError("lost")
                return original(*args)

            return run

        with monkeypatch.context() as m:
            if lost_at == "written":
                m.setattr(Files, "move", lose("written", Files.move))
            elif lost_at == "moved":
                m.setattr(retention, "_put_in_place", lose("moved", retention._put_in_place))
            else:
                delete = Files.delete
                m.setattr(Files, "delete", lambda f, p: (_ for _ in ()).throw(OSError("lost")) if "_old/" in p else delete(f, p))
            with pytest.raises(OSError, match="lost"):
                retention.rewrite_boundary(spark, path, day)
    retention.rewrite_boundary(spark, path, day)
    assert left() == [(0,), (1,), (5,)]
    assert not list((tmp_path / "t" / "_old").glob("load_month=*")) and not (tmp_path / "t" / "_new").exists()
    assert retention.rewrite_boundary(spark, path, day) == []


def raw_of(spark, entity, documents):
    values = [(json.dumps(d | {"_id": str(i), "load_date": "2024-05-01T10:00:00"}, ensure_ascii=False),) for i, d in enumerate(documents)]
    return json_to_raw(streaming.parse(spark.createDataFrame(values, "value string")), entity)


@pytest.mark.parametrize("entity", schemas.ENTITIES)
def test_one_pass_gives_what_the_views_give(spark, entity):
    bad = {"customers": {"first_name": ""}, "stores": {"store_name": " "}, "products": {"price": 0}, "purchases": {"total_amount": "x"}}
    raw = raw_of(spark, entity, [*DOCUMENTS[entity], DOCUMENTS[entity][0] | bad[entity]])
    views = marts.views_of(entity)
    found = marts.routed(raw, views)
    for view in views:
        own = found.filter((F.col("view") == view.name) & (F.col("mart") == view.target))
        wanted = view.build(raw)
        assert rows(own.select(*wanted.columns)) == rows(wanted) and wanted.count()
        refused = found.filter((F.col("view") == view.name) & (F.col("mart") == marts.REJECTED)).select("rejected.*")
        assert rows(refused) == rows(view.rejects(raw))
    assert marts.routed(raw, views, keep_rejects=False).filter(F.col("mart") == marts.REJECTED).count() == 0
    plan = plan_of(found, "simple")
    assert plan.count("Scan") == 1 and "Union" not in plan


def test_the_views_of_a_batch_are_one_job(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    path = str(tmp_path / "raw")
    raw_of(spark, "customers", DOCUMENTS["customers"]).write.parquet(path)
    raw = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("one batch", "views")
    try:
        fill_marts(raw, "customers", lake, 0)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one batch")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert tables.read_mart(spark, lake.mart("customers"), "customers").count() == 2
    assert tables.read_rejected(spark, lake.rejected("customers")).count() == 1
    assert tables.read_mart(spark, lake.mart("purchases"), "purchases").count() == 0  # nothing of it yet


def test_current_addresses_take_new_batches_only(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    raw = raw_of(spark, "customers", DOCUMENTS["customers"])
    fill_marts(raw, "customers", lake, 0)
    table = current_addresses(spark, lake)
    assert table.manifest(spark).number == 1
    wanted = rows(tables.current_mart(spark, lake.mart("address"), "address"))
    assert rows(table.read(spark)) == wanted
    assert current_addresses(spark, lake).manifest(spark).number == 1  # nothing new
    later = raw.withColumn("load_date", F.col("load_date") + F.make_dt_interval(F.lit(40)))
    fill_marts(later, "customers", lake, 1)
    fill_marts(raw_of(spark, "stores", DOCUMENTS["stores"]), "stores", lake, 1)
    folders, last = tables.batch_folders(spark, lake.mart("address"), table.manifest(spark).applied)
    assert folders and all("batch_id=1" in f for f in folders) and set(last.values()) == {1}
    found = current_addresses(spark, lake)
    assert rows(found.read(spark)) == rows(tables.current_mart(spark, lake.mart("address"), "address"))
    assert found.manifest(spark).number == 2


def test_documents_are_counted_by_the_job_that_sends_them(spark, tmp_path):
    class Topics(FileTopics):
        jobs = 0

        def publish(self, messages, topic):
            super().publish(messages, topic)
            type(self).jobs += 1

    topics = Topics(str(tmp_path / "topics"))
    data = {"a": spark.range(0, 25, 1, 3), "b": spark.range(0), "c": spark.range(1)}
    spark.sparkContext.setJobGroup("sending", "sending")
    try:
        sent = publish(data, topics, MaskingConfig("keyed", "key"), LOADED)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("sending")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sent == {"a": 25, "b": 0, "c": 1}
    assert len(jobs) <= Topics.jobs == 3
    assert {n: spark.read.text(topics.path(n)).count() for n in ("a", "c")} == {"a": 25, "c": 1}


def sizes(spark, topics, tmp_path, name):
    with followed(spark) as log:
        start(topics.stream(spark, ["products"]), append_batches(str(tmp_path / name)), str(tmp_path / f"{name}-checkpoint"), name).awaitTermination()
    assert {b[0] for b in log.batches} == {name} and [b[1] for b in log.batches] == list(range(len(log.batches)))
    return [b[2] for b in log.batches]


def test_batches_by_rows_and_by_bytes(spark, tmp_path):
    sending = FileTopics(str(tmp_path / "topics"), rows_per_file=4)
    sending.publish(messages(spark, *[product_message(n) for n in range(10)]).coalesce(1), "products")
    by_rows = sizes(spark, FileTopics(sending.root, max_files_per_trigger=1), tmp_path, "rows")
    assert sorted(by_rows) == [2, 4, 4]
    length = len(product_message(0).encode()) + 1
    by_bytes = sizes(spark, FileTopics(sending.root, max_bytes_per_trigger=str(9 * length)), tmp_path, "bytes")
    assert sum(by_bytes) == 10 and len(by_bytes) == 2
    assert sizes(spark, FileTopics(sending.root), tmp_path, "all") == [10]
    assert KafkaTopics("h:1", min_offsets_per_trigger=10_000).max_wait == "5s"


def test_files_hold_their_documents_or_a_fault(spark, tmp_path):
    texts = {
        "whole": json.dumps({"id": "p", "price": "12.50", "big": 12345678901234567890, "more": {"x": 1}}, indent=2),
        "empty": "",
        "blank": " \n\t",
        "cut": '{"id": "p", ',
        "list": '[{"id": "p"}]',
        "number": "7",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = {os.path.basename(r.path)[:-5]: r for r in scan_files(spark, str(tmp_path)).withColumn("price", F.try_variant_get("document", "$.price", "string")).collect()}
    assert {n: r.fault for n, r in found.items()} == {
        "whole": None, "empty": "empty", "blank": "empty", "cut": "not JSON", "list": "not an object", "number": "not an object",
    }
    assert found["whole"].price == "12.50" and all(r.document is None for n, r in found.items() if n != "whole")
    assert scan_files(spark, str(tmp_path / "missing")).count() == 0


def test_scratch_folders_of_a_scope_go(spark, tmp_path):
    outside = scratch_path(spark, "outside")
    with scratch_scope(spark) as folders:
        table = staged(spark.range(5), "inside")
        with scratch_scope(spark):
            staged(spark.range(2), "inner")
        assert table.count() == 5
    assert len(folders) == 2 and not any(Files(spark, f).exists(f) for f in folders) and outside not in folders
    with pytest.raises(RuntimeError), scratch_scope(spark) as folders:
        staged(spark.range(5), "inside")
        raise RuntimeError
    assert folders and not any(Files(spark, f).exists(f) for f in folders)


def test_a_report_leaves_no_scratch(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for entity in schemas.ENTITIES:
        values = [(entity, json.dumps(d | {"_id": "1", "load_date": "2024-05-01T10:00:00"}, ensure_ascii=False)) for d in DOCUMENTS[entity]]
        ingest_batch(entity, lake)(spark.createDataFrame(values, "topic string, value string"), 0)
    config = FeatureConfig(as_of=dt.date(2024, 5, 1))
    root = os.path.dirname(scratch_path(spark, "x"))
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    path = publish_report(spark, lake, str(tmp_path / "reports"), config)
    assert set(os.listdir(root)) == before and os.path.isdir(path)
    assert "mart=address" not in plan_of(report(spark, lake, config))
