import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources.readers import file_messages
from ledgerlens.streaming import commits, events, id_index, ingest, lookup, merge, monitor, windows

T0 = dt.datetime(2024, 1, 1)


def message(i, partition=0, offset=None, **changes):
    body = {
        "event_id": f"e{i}", "transaction_id": f"t{i}", "event_time": (T0 + dt.timedelta(minutes=i)).isoformat(),
        "customer_id": f"c{i % 3}", "amount_gbp": 10.0 + i, "status": "completed", "is_flagged_fraud": i % 4 == 0,
        "risk_score": 70.0 if i % 4 == 0 else 10.0, **changes,
    }
    return json.dumps({k: v for k, v in body.items() if v is not None}), partition, i if offset is None else offset


SCHEMA = "value string, partition int, offset bigint"


@pytest.fixture
def batch(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def test_decode_defaults_and_dead_letters(batch):
    decoded = events.decode(batch([message(1), ("{not json", 0, 2), message(3, event_id=None), (None, 1, 4)]))
    row = events.sink_rows(decoded).collect()
    assert len(row) == 1 and row[0].asDict().keys() == set(events.SINK_COLUMNS)
    r = row[0]
    assert (r["currency"], r["merchant_name"], r["amount"], r["is_kyc_verified"]) == ("GBP", "", 0.0, False)
    assert r["event_time"] == T0 + dt.timedelta(minutes=1) and r["kafka_seq"] == 1
    letters = events.dead_letters(decoded)
    assert sorted(x["error_message"] for x in letters.collect()) == ["malformed JSON", "malformed JSON", "missing event_id"]
    again = sorted(x["dlq_id"] for x in events.dead_letters(decoded).collect())
    assert again == sorted(x["dlq_id"] for x in letters.collect()) and len(set(again)) == 3


def test_alerts(batch):
    rows = events.sink_rows(events.decode(batch([message(0), message(1), message(4, risk_score=60.0),
                                                 message(8, is_high_risk_merchant=True)])))
    got = {r["transaction_id"]: r["reason"] for r in events.fraud_alerts(rows).collect()}
    assert got == {"t0": "velocity_check", "t8": "high_risk_merchant"}


def test_batches_store_each_event_once_and_replay(spark, batch, tmp_path):
    tables = ingest.StreamTables(spark, str(tmp_path))
    tables.write_batch(batch([message(i) for i in range(10)] + [message(3, offset=99, status="later"), ("junk", 0, 50)]), 0)
    second = [message(i) for i in range(8, 15)]
    for _ in range(2):                                       # the second run replays batch 1
        tables.write_batch(batch(second), 1)
        rows = tables.read("transactions")
        assert sorted(r[0] for r in rows.select("event_id").collect()) == sorted(f"e{i}" for i in range(15))
        assert rows.filter("event_id = 'e3'").first()["status"] == "completed"
        assert tables.read("dlq").count() == 1
        assert tables.read("fraud_alerts").count() == 4
        assert tables.read("batches").agg(F.sum("rows_written"), F.sum("fraud_rows")).first()[:] == (15, 4)


def test_large_batches_join_by_key(spark, batch, tmp_path, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_KEYS", 0)
    tables = ingest.StreamTables(spark, str(tmp_path))
    for number in range(2):
        tables.write_batch(batch([message(i) for i in range(5 + number)]), number)
    assert tables.read("transactions").count() == 6


def test_rows_without_a_usable_time(spark, batch, tmp_path):
    tables = ingest.StreamTables(spark, str(tmp_path))
    tables.write_batch(batch([message(i * 700) for i in range(6)]), 0)
    tables.write_batch(batch([message(i * 700) for i in range(3, 9)] + [message(1, event_time="bad")]), 1)
    tables.write_batch(batch([message(1, event_time="bad"), message(0)]), 2)
    assert tables.read("transactions").count() == 10
    assert tables.read("transactions").select("event_id").distinct().count() == 10


def test_a_new_checkpoint_loses_and_repeats_nothing(spark, batch, tmp_path):
    tables = ingest.StreamTables(spark, f"{tmp_path}/out")
    for number, ids in enumerate((range(6), range(4, 9))):
        # The second query has a new checkpoint, counts its batches from 0, and finds a topic without the first rows.
        inbox = f"{tmp_path}/in{number}"
        batch([message(i) for i in ids]).coalesce(1).write.parquet(inbox)
        q = ingest.start_ingest(file_messages(spark, inbox), tables, f"{tmp_path}/checkpoint{number}", every=None)
        q.awaitTermination()
    assert sorted(r[0] for r in tables.read("transactions").select("event_id").collect()) == sorted(f"e{i}" for i in range(9))
    made = tables.log.lines()
    assert [c.commit.rpartition("-")[2] for c in made.values()] == ["0", "0"]
    assert len({c.commit for c in made.values()}) == 2


def test_a_half_written_batch_does_not_exist(spark, batch, tmp_path, monkeypatch):
    tables = ingest.StreamTables(spark, f"{tmp_path}/stream")
    target, log = f"{tmp_path}/transactions", f"{tmp_path}/log"
    rows_of(batch, []).withColumnRenamed("event_time", "transaction_at").select(*merge.MERGED_COLUMNS).write.parquet(target)

    def merged():
        return merge.merge_into_warehouse(tables.read("transactions", with_batch=True), target, log)

    tables.write_batch(batch([message(i) for i in range(3)]), 0)
    with monkeypatch.context() as cut:
        cut.setattr(commits.CommitLog, "add", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            tables.write_batch(batch([message(i) for i in range(2, 7)] + [("junk", 0, 9)]), 1)
    assert tables.read("transactions").count() == 3 and tables.read("dlq").count() == 0
    assert merged() == 3
    tables.write_batch(batch([message(i) for i in range(2, 7)] + [("junk", 0, 9)]), 1)
    assert tables.read("transactions").count() == 7 and tables.read("dlq").count() == 1
    assert merged() == 4 and merged() == 0
    # What the cut off try left of the index goes.
    assert tables.vacuum() == 1 and tables.vacuum() == 0
    tables.write_batch(batch([message(i) for i in range(8)]), 2)
    assert tables.read("transactions").count() == 8


def test_markers_are_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "GATHER", 4)
    log = commits.CommitLog(spark, f"{tmp_path}/commits")
    assert log.last() is None and log.table().count() == 0
    for i in range(10):
        log.add(f"q-{i}", [commits.Segment(f"s{i}", 0, 0, 1)])
        assert log.last().commit == f"q-{i}" and log.last().segments[0].name == f"s{i}"
    assert sorted(map(tuple, log.table().collect())) == [(i, f"q-{i}") for i in range(10)]
    assert log.has("q-2") and not log.has("q-10")
    assert len(log._files()) == 3


def ids_of(spark, low, high):
    return spark.range(low, high, numPartitions=1).selectExpr("concat('evt-', id) AS id")


def test_index_finds_what_is_stored_and_reads_little(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "BLOCK_IDS", 50)
    monkeypatch.setattr(id_index, "FILE_BITS", 2)
    monkeypatch.setattr(id_index, "FAN", 4)
    index, segments = id_index.IdIndex(spark, f"{tmp_path}/ids"), []
    read = []
    for i in range(20):
        batch = ids_of(spark, i * 100, i * 100 + 100)
        read.append(len(index.reach(batch, segments)))
        segments = index.merged([*segments, index.write(batch, 0, 100)])
    # New ids: files are read only where a filter is wrong, however many batches there are.
    assert max(read) <= 3 and sum(read) <= 10
    assert sorted(s.level for s in segments) == [1, 2] and sum(s.ids for s in segments) == 2000
    some = ids_of(spark, 1_990, 2_010).unionByName(ids_of(spark, 5, 7)).unionByName(spark.createDataFrame([(None,)], "id string"))
    found = index.known(some, segments)
    assert sorted(r[0] for r in found.collect()) == sorted(f"evt-{i}" for i in [5, 6, *range(1990, 2000)])
    every = ids_of(spark, 0, 2_000)
    assert index.known(every, segments).count() == 2000
    # Two ids lie in two files at most.
    assert 1 <= len(index.reach(ids_of(spark, 3, 5), segments)) <= 3
    assert index.vacuum(segments) == 20 + 5 - 1
    assert index.known(every, segments).count() == 2000


def test_bits_of_a_filter(spark):
    held = [0, 1, 7, 8, 9, 4_095, 32_767]
    bitmap = spark.createDataFrame([(i,) for i in held], "place bigint").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    asked = spark.createDataFrame([(i,) for i in [*held, 2, 15, 16, 32_766]], "place bigint").crossJoin(bitmap)
    got = {r[0] for r in asked.filter(id_index.has_bits(F.col("bitmap"), F.array("place"))).select("place").collect()}
    assert got == set(held)


def test_stream_from_files(spark, batch, tmp_path):
    inbox, folder = f"{tmp_path}/in", f"{tmp_path}/out"
    batch([message(i) for i in range(6)]).coalesce(1).write.parquet(inbox)
    tables = ingest.StreamTables(spark, folder)

    def run():
        q = ingest.start_ingest(file_messages(spark, inbox), tables, f"{folder}/checkpoint", every=None)
        q.awaitTermination()

    run()
    batch([message(i) for i in range(4, 9)]).coalesce(1).write.mode("append").parquet(inbox)
    run()
    run()
    assert tables.read("transactions").count() == 9
    assert tables.read("batches").count() == 2


def test_streaming_dedup(spark, batch, tmp_path):
    inbox = f"{tmp_path}/in"
    batch([message(i % 4) for i in range(12)]).write.parquet(inbox)
    rows = events.deduplicated(events.sink_rows(events.decode(file_messages(spark, inbox, 10))))
    q = rows.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_out").count() == 4


def rows_of(batch, ids, **changes):
    return events.sink_rows(events.decode(batch([message(i, **changes) for i in ids])), F.col("event_time"))


def test_merge(spark, batch, tmp_path):
    target, log = f"{tmp_path}/transactions", f"{tmp_path}/log"
    merge.new_transactions(rows_of(batch, range(3)), spark.createDataFrame([], "transaction_id string")) \
        .select(*merge.MERGED_COLUMNS).write.parquet(target)
    stream = rows_of(batch, [1, 2, 3, 4, 4])
    assert merge.merge_into_warehouse(stream, target, log) == 2
    assert merge.merge_into_warehouse(stream, target, log) == 0
    late = stream.unionByName(rows_of(batch, [77], event_time="2023-12-31T00:00:00"))
    assert merge.merge_into_warehouse(late, target, log, late_rows=False) == 0
    assert merge.merge_into_warehouse(late, target, log) == 1
    stored = spark.read.parquet(target)
    assert sorted(r[0] for r in stored.select("transaction_id").collect()) == ["t0", "t1", "t2", "t3", "t4", "t77"]
    lines = spark.read.parquet(log)
    assert sorted(r["rows_merged"] for r in lines.collect()) == [0, 0, 1, 2]
    assert merge.last_mark(lines).first()["_mark"] == T0 + dt.timedelta(minutes=4)


def test_monitors(spark, batch):
    rows = rows_of(batch, range(120))
    now = F.lit((T0 + dt.timedelta(minutes=119 + 11)).isoformat(sep=" ")).cast("timestamp")
    fresh = monitor.freshness(rows, now).first()
    assert (fresh["minutes_since_write"], fresh["status"]) == (11, "stale")
    recent = monitor.recent_anomalies(rows).first()
    assert recent["total"] == 100 and recent["fraud_anomaly"] and not recent["amount_anomaly"]
    exact, near = monitor.running_totals(rows).first(), monitor.running_totals(rows, approximate=True).first()
    assert exact["customers"] == near["customers"] == 3
    ends = spark.createDataFrame([(0, 50), (1, 10)], "partition int, end_offset bigint")
    committed = spark.createDataFrame([(0, 20), (1, 15), (2, 9)], "partition int, committed_offset bigint")
    lag = monitor.partition_lag(committed, ends)
    assert sorted(r["lag"] for r in lag.collect()) == [0, 0, 30]
    assert monitor.total_lag(lag).first()[:] == (30, "healthy")


def test_empty_first_batch(spark, batch, tmp_path):
    tables = ingest.StreamTables(spark, str(tmp_path))
    tables.write_batch(batch([("junk", 0, 1), ("{", 0, 2)]), 0)
    assert tables.read("transactions").count() == 0
    tables.write_batch(batch([message(i) for i in range(3)]), 1)
    tables.write_batch(batch([message(i) for i in range(4)]), 2)
    assert tables.read("transactions").count() == 4
    assert tables.read("dlq").count() == 2


def test_merge_follows_arrival(spark, batch, tmp_path):
    tables = ingest.StreamTables(spark, f"{tmp_path}/stream")
    target, log = f"{tmp_path}/transactions", f"{tmp_path}/log"
    rows_of(batch, []).withColumnRenamed("event_time", "transaction_at").select(*merge.MERGED_COLUMNS).write.parquet(target)
    added = []
    for number, ids in enumerate(([10, 11], [1, 2, 10], [])):
        tables.write_batch(batch([message(i) for i in ids] + [("junk", 0, number)]), number)
        added.append(merge.merge_into_warehouse(tables.read("transactions", with_batch=True), target, log))
    assert added == [2, 2, 0]
    assert spark.read.parquet(target).count() == 4


def plain(df, *order):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("build, key, count", [
    (windows.rates, ["window_start"], "events"), (windows.customer_velocity, ["window_start", "customer_id"], "payments"),
])
def test_windows_of_a_stream_equal_those_of_the_batch(spark, batch, tmp_path, build, key, count):
    inbox, folder = f"{tmp_path}/in", f"{tmp_path}/out"

    def run(ids, **changes):
        batch([message(i, **changes) for i in ids] + [("junk", 0, 1)]).coalesce(1).write.mode("append").parquet(inbox)
        windows.start_windows(file_messages(spark, inbox), build, folder, every=None).awaitTermination()
        return spark.read.parquet(f"{folder}/rows")

    step = 11 * 60
    every = [i * step for i in range(90)]
    run([*every[:45], *every[:3]])                           # three events are sent twice
    run(every[45:])
    # An empty run after the last one changes nothing; a row of the first day is then far too late.
    emitted = run([step // 2], event_time=(T0 + dt.timedelta(minutes=3)).isoformat())
    rows = rows_of(batch, every)
    latest = F.lit((T0 + dt.timedelta(minutes=every[-1])).isoformat(sep=" ")).cast("timestamp")
    want = windows.closed(build(rows), latest)
    assert plain(emitted) == plain(want) and emitted.count() > 20
    stored = rows.unionByName(rows_of(batch, [step // 2], event_time=(T0 + dt.timedelta(minutes=3)).isoformat()))
    late = windows.late_counts(emitted, windows.closed(build(stored), latest), key, count).collect()
    assert late and all(r["late"] == 1 for r in late)
    assert all(r["window_start"] <= T0 + dt.timedelta(minutes=3) for r in late)


def test_velocity_counts_thirty_days(spark, batch):
    rows = rows_of(batch, [0, 60, 29 * 1440, 30 * 1440], customer_id="c", amount_gbp=0.1)
    found = {r["window_start"]: (r["payments"], r["volume_gbp"]) for r in windows.customer_velocity(rows).collect()}
    assert found[T0] == (3, 0.3) and found[T0 + dt.timedelta(days=1)] == (2, 0.2) and len(found) == 60


def test_a_batch_in_few_pieces_is_spread_before_it_is_decoded(spark, tmp_path, monkeypatch):
    pieces = []
    decode = events.decode
    monkeypatch.setattr(events, "decode", lambda m: pieces.append(
        sorted(r["count"] for r in m.groupBy(F.spark_partition_id()).count().collect())
    ) or decode(m))
    one = spark.range(20_000).coalesce(1).selectExpr("repeat('x', 300) || id as value", "0 as partition", "id as offset")
    keep = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        ingest.StreamTables(spark, str(tmp_path / "t")).write_batch(one, 0)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(pieces[0]) == 20_000 and len(pieces[0]) == 4 and pieces[0][-1] < 10_000


def test_a_batch_holds_no_texts_of_usable_messages(spark, batch, tmp_path, monkeypatch):
    """Texts are kept for dead letters only, and new rows are read from where they lie."""
    held, letters = [], events.dead_letters

    def noted(decoded):
        held.append({(r["value"] is None, r["error"] is None) for r in decoded.select("value", "error").collect()})
        return letters(decoded)

    monkeypatch.setattr(events, "dead_letters", noted)
    read, alerts = [], events.fraud_alerts
    monkeypatch.setattr(events, "fraud_alerts", lambda rows: read.append(len(rows.inputFiles())) or alerts(rows))
    tables = ingest.StreamTables(spark, f"{tmp_path}/held")
    messages = batch([message(i) for i in range(9)] + [("junk", 0, 9)])
    tables.write_batch(messages, 0)
    tables.write_batch(messages, 1)
    assert held == [{(True, True), (False, False)}] * 2 and read[0] > 0 and read[1] == 0
    assert [r["raw_message"] for r in tables.read("dlq").collect()] == ["junk"] * 2
    assert sorted(r["rows_written"] for r in tables.read("batches").collect()) == [0, 9]
    assert tables.read("fraud_alerts").count() == 3
