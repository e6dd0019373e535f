import glob
import os

import pytest
from conftest import values
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from logweir.operators import geo, records, windows
from logweir.plans import catalog, layers
from logweir.registry import fixtures as X
from logweir.registry import queries as Q
from logweir.schema import DEMO_SCHEMA, GEO_LABELS, ODS_SCHEMA
from logweir.sources import readers
from logweir.streaming import commit, rolling, sinks, upsert
from logweir.streaming.keyed_table import KeyedTable
from logweir.streaming.ledger import KEPT


def line(seq, time, client="10.0.0.1", domain="a.com", rcode="0"):
    return (seq, f"{client}|{domain}|{time}|1.1.1.1|{rcode}|1|a.com|m|8.8.8.8")


class Feed:
    """A folder of message files; each call adds one file."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def add(self, *lines):
        df = self.spark.createDataFrame(list(lines), "seq bigint, value string")
        df.selectExpr("cast(value as binary) value", "seq").coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self, files=1):
        return readers.file_stream(self.spark, self.folder, "value BINARY, seq BIGINT", files_per_trigger=files)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def test_intake_limit_gives_one_batch_per_file(spark, feed, tmp_path):
    for i in range(3):
        feed.add(line(i, "20240131120000"))
    rows = records.parse_records(feed.stream())
    query = sinks.run_to_end(sinks.to_csv(rows, str(tmp_path / "o"), str(tmp_path / "c")))
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert len(glob.glob(str(tmp_path / "o" / "*.csv"))) == 3


def test_restart_neither_loses_nor_repeats(spark, feed, tmp_path):
    out = str(tmp_path / "o")
    for i in range(2):
        feed.add(line(i, "20240131120000"), line(10 + i, "20240131120000"))
        rows = records.parse_records(feed.stream(), keep=["seq"])
        sinks.run_to_end(sinks.to_csv(rows, out, str(tmp_path / "c")))
    assert sorted(int(r.seq) for r in spark.read.csv(out, header=True).collect()) == [0, 1, 10, 11]


def test_late_rows_are_dropped_once_their_window_is_closed(spark, feed, tmp_path):
    feed.add(line(1, "20240131120000"))
    feed.add(line(2, "20240131130000"))
    feed.add(line(3, "20240131140000"))
    feed.add(line(4, "20240131120000"), line(5, "20240131140005"))
    timed = layers.com_clients(feed.stream())
    counts = windows.client_window_counts(timed, watermark="10 seconds")
    out = str(tmp_path / "o")
    writer = sinks.stream_writer(counts, "parquet", options={"path": out, "checkpointLocation": str(tmp_path / "c")})
    sinks.run_to_end(sinks.triggered(writer).start())
    got = windows.bounds_as_text(spark.read.parquet(out)).where("window_start like '%12:00:00'")
    assert [r.n for r in got.collect()] == [1]


def test_arrival_state_falls_as_the_clock_goes_on(spark, feed, tmp_path):
    for minute in (0, 1, 30, 60):
        feed.add(*[line(minute, f"2024013112{minute:02d}00" if minute < 60 else "20240131130000", client=f"10.0.{minute}.{i}") for i in range(5)])
    timed = records.with_event_time(records.parse_records(feed.stream()))
    sums = windows.arrival_window_sums(windows.with_arrival_time(timed, transport="event_time"))
    writer = sinks.stream_writer(sums, "noop", "update", {"checkpointLocation": str(tmp_path / "c")})
    query = sinks.run_to_end(sinks.triggered(writer).start())
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # Four windows a row; those of the first half hour are gone at the end.
    assert max(held) > held[-1] and held[-1] <= 5 * 4


def test_sorted_result_needs_complete_mode(spark, feed, tmp_path):
    feed.add(line(1, "20240131120000"))
    top = layers.hop_top_clients(feed.stream())
    with pytest.raises(AnalysisException):
        top.writeStream.outputMode("update").format("console").option("checkpointLocation", str(tmp_path)).start()


def test_upsert_batch_can_be_repeated_and_compacted(spark, feed, tmp_path):
    out = str(tmp_path / "o")
    feed.add(line(1, "20240131120000"), line(2, "20240131120000", rcode="2"))
    feed.add(line(3, "20240131120000", rcode="3"), line(4, "20240131120005"))
    for run in range(2):
        # The second run has lost its progress and delivers every batch again.
        rows = records.with_id(records.parse_records(feed.stream(), keep=["seq"]), keep=["seq"])
        sinks.run_to_end(upsert.upsert_stream(rows, out, str(tmp_path / f"c{run}")))
    want = [("20240131120000", "3"), ("20240131120005", "0")]
    assert values(upsert.read_upserts(spark, out).select("time", "rcode")) == want
    assert upsert.compact_upserts(spark, out)
    assert values(upsert.read_upserts(spark, out).select("time", "rcode")) == want
    table = KeyedTable(spark, out)
    table.clean()
    assert len(glob.glob(f"{out}/data/*")) == 1
    assert values(upsert.read_upserts(spark, out).select("time", "rcode")) == want


def test_two_checkpoints_keep_all_rows_and_compaction_does_not_stop_them(spark, tmp_path):
    """Batch 0 of the second query must not replace batch 0 of the first; the table is folded between two batches."""
    out = str(tmp_path / "o")
    for run in range(2):
        feed = Feed(spark, tmp_path / f"feed{run}")
        for i in range(3):
            feed.add(line(10 * run + i, f"2024013112{run}{i}00"))
            rows = records.with_id(records.parse_records(feed.stream(), keep=["seq"]), keep=["seq"])
            sinks.run_to_end(upsert.upsert_stream(rows, out, str(tmp_path / f"c{run}")))
            if i == 1:
                assert upsert.compact_upserts(spark, out)
    assert sorted(r.seq for r in upsert.read_upserts(spark, out).collect()) == [0, 1, 2, 10, 11, 12]
    assert len(KeyedTable(spark, out).state()[1]["live"]) == 2


def repeat_last_batch(checkpoint):
    """Forget that the last batch of a query is done, as after a failure between writing and noting it."""
    last = max(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    forget(last)


def forget(file):
    """Remove a file and its checksum."""
    for name in (file, os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")):
        if os.path.exists(name):
            os.remove(name)


def test_deletes_of_a_stream_and_repeated_batches(spark, feed, tmp_path):
    out, gone = str(tmp_path / "o"), Feed(spark, tmp_path / "gone")
    feed.add(line(1, "20240131120000"), line(2, "20240131120005"))

    def put():
        rows = records.with_id(records.parse_records(feed.stream(), keep=["seq"]), keep=["seq"])
        sinks.run_to_end(upsert.upsert_stream(rows, out, str(tmp_path / "c")))

    put()
    gone.add(line(3, "20240131120000"))
    keys = records.with_id(records.parse_records(gone.stream())).select("id")
    sinks.run_to_end(upsert.delete_stream(keys, out, str(tmp_path / "d")))
    assert [r.seq for r in upsert.read_upserts(spark, out).collect()] == [2]
    # The upsert of the deleted row comes again: it was applied, so it does not bring the row back.
    repeat_last_batch(tmp_path / "c")
    put()
    assert [r.seq for r in upsert.read_upserts(spark, out).collect()] == [2]


def test_partition_commit_over_a_restart(spark, feed, tmp_path):
    out, progress = str(tmp_path / "o"), str(tmp_path / "c")

    def run():
        rows = records.with_event_time(records.parse_records(feed.stream()))
        sinks.run_to_end(commit.commit_stream(rows, out, progress))
        return values(commit.committed_partitions(spark, out).select("dt", "hr", "rows"))

    feed.add(line(1, "20240131120000"), line(2, "20240131125959"))
    assert run() == []
    feed.add(line(3, "20240131130009"))
    assert run() == []
    feed.add(line(4, "20240131130010"))
    assert run() == [("2024-01-31", "12", 2)]
    assert os.path.exists(f"{out}/data/dt=2024-01-31/hr=12/_SUCCESS")
    assert not os.path.exists(f"{out}/data/dt=2024-01-31/hr=13/_SUCCESS")
    feed.add(line(5, "20240131120001"), line(6, "20240131150000"))
    assert run() == [("2024-01-31", "12", 2), ("2024-01-31", "13", 2)]
    assert spark.read.orc(f"{out}/data").count() == 6


@pytest.mark.parametrize("noted", [True, False])
def test_partition_commit_delivers_a_repeated_batch_once(spark, feed, tmp_path, noted):
    """The last batch is done again, with its state already noted or lost with it."""
    out = str(tmp_path / "o")
    feed.add(line(1, "20240131120000"))
    feed.add(line(2, "20240131140000"))
    for run in range(2):
        rows = records.with_event_time(records.parse_records(feed.stream()))
        sinks.run_to_end(commit.commit_stream(rows, out, str(tmp_path / "c")))
        if not run:
            repeat_last_batch(tmp_path / "c")
            if not noted:
                forget(max(glob.glob(f"{out}/state/*.json")))
    assert spark.read.orc(f"{out}/data").count() == 2
    assert values(commit.committed_partitions(spark, out).select("hr", "rows")) == [("12", 1)]


def test_staged_addresses_are_in_files_for_all_cores(spark, sf_dir):
    folder, per_chunk = X.staged_clients(spark, sf_dir)
    assert per_chunk == X.chunk_files(spark, X.events(spark, sf_dir).count())
    assert len(glob.glob(f"{folder}/*.parquet")) == X.CHUNKS * per_chunk
    assert values(spark.read.parquet(folder)) == values(X.mixed_clients(spark, sf_dir))


def test_success_files_of_many_hours_are_put_at_the_same_time(spark, tmp_path, monkeypatch):
    """More hours than are put at once, among them one that has its file already; none is put by a call of its own."""
    monkeypatch.setattr(commit, "PUT_AT_ONCE", 4)
    hours = [str(tmp_path / f"hr={h:02d}" / "_SUCCESS") for h in range(24)]
    commit.put_file(spark, hours[3], "old")
    commit.put_marks(spark, hours)
    commit.put_marks(spark, [])
    assert all(os.path.getsize(h) == 0 for h in hours)


def test_partition_commit_over_a_new_checkpoint(spark, tmp_path):
    """No hour and no row is lost; rows after publication are recorded; the state stays small over many batches."""
    out = str(tmp_path / "o")
    for run in range(2):
        feed = Feed(spark, tmp_path / f"feed{run}")
        for i in range(8):
            feed.add(line(i, f"20240131{10 + i + 4 * run}0000"))
        rows = records.with_event_time(records.parse_records(feed.stream()))
        sinks.run_to_end(commit.commit_stream(rows, out, str(tmp_path / f"c{run}")))
    assert spark.read.orc(f"{out}/data").count() == 16
    got = values(commit.committed_partitions(spark, out).select("hr", "rows"))
    # Hours 14 to 15 were published by the first query; the second brings them again, late.
    assert got == [(str(h), 2 if h in (16, 17) else 1) for h in range(10, 20)]
    assert values(commit.late_partitions(spark, out).select("hr", "rows")) == [("14", 1), ("15", 1)]
    assert len(glob.glob(f"{out}/state/*.json")) <= KEPT


def test_hours_that_come_and_pass():
    empty = {"open": {}, "latest": 0, "published": -1}
    hour = lambda h: f"1970-01-01 {h:02d}"
    at = lambda h, s=0: (h * 3600 + s) * 1_000_000
    state, due, late = commit.advanced(empty, {hour(1): (3, at(1, 5)), hour(2): (1, at(2, 9))}, "10 seconds", "1 hour")
    assert (state["open"], due, late) == ({hour(1): 3, hour(2): 1}, {}, {})
    state, due, late = commit.advanced(state, {hour(2): (2, at(2, 10))}, "10 seconds", "1 hour")
    assert (state["open"], due, late) == ({hour(2): 3}, {hour(1): 3}, {})
    # An hour without rows so far that has passed already is late, an open one still takes rows.
    state, due, late = commit.advanced(state, {hour(0): (1, at(0)), hour(1): (4, at(1)), hour(2): (1, at(2))}, "10 seconds", "1 hour")
    assert (state["open"], due, late) == ({hour(2): 4}, {}, {hour(0): 1, hour(1): 4})


def test_text_files_are_rolled_once(spark, feed, tmp_path):
    raw, packed = str(tmp_path / "raw"), str(tmp_path / "packed")

    def run(*minutes):
        for i in minutes:
            feed.add(line(i, f"2024013112{i:02d}00"))
        sinks.run_to_end(sinks.to_text(records.parse_records(feed.stream()), raw, str(tmp_path / "c")))

    run(*range(6))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # Just written: the bin is open, then it has been idle for long enough.
    assert rolling.roll_text(spark, raw, packed, idle_seconds=3600, roll_seconds=3600) == 0
    assert rolling.rolled_text(spark, packed).count() == 0
    assert rolling.roll_text(spark, raw, packed, idle_seconds=0) == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert len(glob.glob(f"{raw}/*.txt")) == 6 and len(glob.glob(f"{packed}/*/*.txt")) == 1
    assert rolling.rolled_text(spark, packed).where("value = '(10.0.0.1,a.com,20240131120000,1.1.1.1,0,1,a.com,m,8.8.8.8)'").count() == 1
    first = {p: os.path.getmtime(p) for p in glob.glob(f"{packed}/*/*.txt")}
    assert rolling.roll_text(spark, raw, packed, idle_seconds=0) == 0
    # The second roll would fail on a file it has packed already, as they are gone.
    for name in glob.glob(f"{raw}/*.txt"):
        forget(name)
    run(7, 8, 9)
    size = os.path.getsize(glob.glob(f"{raw}/*.txt")[0])
    assert rolling.roll_text(spark, raw, packed, file_bytes=2 * size, idle_seconds=0) == 2
    assert {p: os.path.getmtime(p) for p in first} == first and len(glob.glob(f"{packed}/*/*.txt")) == 3
    assert rolling.rolled_text(spark, packed).count() == 9


def test_bins_close_by_size_age_and_idleness():
    files = [(0, "a", 60), (5, "b", 50), (6, "c", 40), (9, "d", 200), (10, "e", 10)]
    names = lambda now, **limits: [[f[1] for f in b] for b in rolling.planned(files, now, 100, **limits)]
    assert names(12, roll_seconds=300, idle_seconds=20) == [["a"], ["b", "c"], ["d"]]
    assert names(31, roll_seconds=300, idle_seconds=20)[-1] == ["e"]
    assert names(12, roll_seconds=2, idle_seconds=20)[-1] == ["e"]
    assert rolling.planned([], 0) == []


def test_jdbc_error_fails_the_query(spark, feed, tmp_path):
    # No database here: only that an error reaches the caller instead of ending the process.
    feed.add(line(1, "20240131120000"))
    query = sinks.to_jdbc(records.parse_records(feed.stream()), "jdbc:nothing:x", "t", str(tmp_path / "c"), batch_column="batch")
    with pytest.raises(StreamingQueryException):
        sinks.run_to_end(query)


def test_kafka_options():
    got = readers.kafka_options("h:9092", "dns", "earliest", max_offsets=500)
    assert got == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "dns", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "fetchOffset.numRetries": "3", "maxOffsetsPerTrigger": "500",
    }
    assert "maxOffsetsPerTrigger" not in readers.kafka_options("h", "t")


def test_layers_prune_partitions(spark, sf_dir):
    ods = Q.ods_load(spark, sf_dir)
    assert ods.columns == ODS_SCHEMA.names
    plan = ods.where("day = '31'").select("client_ip")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "ReadSchema: struct<client_ip:string>" in plan


def test_console(spark, feed, tmp_path):
    feed.add(line(1, "20240131120000"))
    query = sinks.run_to_end(sinks.to_console(records.parse_records(feed.stream()), str(tmp_path / "c")))
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_catalog(spark, tmp_path):
    catalog.use_database(spark, "weir_test", create=True)
    try:
        catalog.create_table(spark, "demo", DEMO_SCHEMA, partition_by=("year", "month", "day"), path=str(tmp_path / "t"))
        catalog.create_table(spark, "demo", DEMO_SCHEMA)
        assert "weir_test" in [r[0] for r in catalog.list_databases(spark).collect()]
        assert "demo" in [r.tableName for r in catalog.list_tables(spark, "weir_test").collect()]
        assert readers.table_head(spark, "demo", 3).count() == 0
        catalog.drop_table(spark, "demo")
        catalog.drop_table(spark, "demo")
        assert catalog.list_tables(spark).where("tableName = 'demo'").count() == 0
    finally:
        catalog.use_database(spark, "default")


def test_staged_chunks_are_in_time_order(spark, sf_dir):
    folder, files = X.staged_messages(spark, sf_dir)
    rows = spark.read.parquet(folder).withColumns(
        {"t": F.col("_metadata.file_modification_time"), "f": F.col("_metadata.file_path")}
    )
    spans = rows.groupBy("t", "f").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("t").collect()
    assert len(spans) == files * X.CHUNKS
    chunks = [spans[i : i + files] for i in range(0, len(spans), files)]
    for a, b in zip(chunks, chunks[1:]):
        assert max(r.hi for r in a) < min(r.lo for r in b)
    assert spark.read.parquet(folder).count() == X.dns_lines(spark, sf_dir).count()


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_located_stream_equals_located_table(spark, sf_dir, tmp_path, options):
    segments = X.saved_geo(spark, sf_dir)
    asked = records.parse_records(Q.messages(spark, sf_dir), keep=["seq"]).select("seq", "client_ip")
    writer = sinks.stream_writer(
        geo.locate(asked, segments, GEO_LABELS, **options), "parquet",
        options={"path": str(tmp_path / "o"), "checkpointLocation": str(tmp_path / "c")},
    )
    sinks.run_to_end(sinks.triggered(writer).start())
    batch = geo.locate(X.dns(spark, sf_dir).select("seq", "client_ip"), segments, GEO_LABELS)
    assert values(spark.read.parquet(str(tmp_path / "o"))) == values(batch)
