"""One callable per operator: (spark, sf_dir) to a DataFrame over the whole tables."""

import uuid

from pyspark.sql import functions as F

from logweir.functions import ip as I
from logweir.functions import parsing as P
from logweir.operators import analysis, cidr, geo, keyed, records, skew, windows
from logweir.plans import catalog, layers
from logweir.registry import fixtures as X
from logweir.schema import GEO_LABELS, RECORD_FIELDS, strings
from logweir.session import work_folder
from logweir.sources import readers
from logweir.streaming import commit, rolling, sinks, upsert
from logweir.streaming.keyed_table import KeyedTable

QUERIES = {}
MESSAGE_SCHEMA = "value BINARY, seq BIGINT"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# Parsing and projections


@query
def parse_pipe(spark, sf_dir):
    return X.dns(spark, sf_dir)


@query
def parse_json(spark, sf_dir):
    return records.parse_records(X.as_json(X.dns_lines(spark, sf_dir)), "json", keep=["seq"])


@query
def parse_rejects(spark, sf_dir):
    messages = X.as_json(X.dns_lines(spark, sf_dir))
    return records.rejected_messages(messages, "json", keep=["seq"], need_date=True)


@query
def parse_csv_ddl(spark, sf_dir):
    rows = records.parse_delimited_table(X.dns_lines(spark, sf_dir), keep=["seq"])
    return rows.withColumn("event_time", P.time_text(F.col("event_time")))


@query
def ods_rows(spark, sf_dir):
    return records.ods_rows(X.dns(spark, sf_dir), keep=["seq"])


@query
def composite_id(spark, sf_dir):
    return records.with_id(X.dns(spark, sf_dir), keep=["seq"])


@query
def record_rename(spark, sf_dir):
    return records.index_rows(X.dns(spark, sf_dir), keep=["seq"])


@query
def rcode_typed(spark, sf_dir):
    return records.demo_rows(X.dns(spark, sf_dir), keep=["seq"])


@query
def suffix_filter(spark, sf_dir):
    return records.domain_ends_with(X.dns(spark, sf_dir))


@query
def event_time(spark, sf_dir):
    plain, noon = P.event_time(F.col("time")), P.event_time(F.col("time"), h12_compat=True)
    return X.dns(spark, sf_dir).select(
        "seq",
        P.time_text(plain).alias("event_time"),
        P.time_text(noon).alias("event_time_h12"),
        F.unix_millis(plain).alias("event_millis"),
    )


def csv_files(spark, sf_dir):
    """Header-less files of the nine columns, empty fields left blank."""
    folder = work_folder(spark, "csv")
    X.dns(spark, sf_dir).select(*RECORD_FIELDS).write.csv(folder, emptyValue="")
    return readers.csv_records(spark, folder)


@query
def csv_normalize(spark, sf_dir):
    return records.normalise(csv_files(spark, sf_dir))


@query
def csv_batch_write(spark, sf_dir):
    """Normalised records written as files without a header; blanks read back as null."""
    out = work_folder(spark, "csv-normal")
    records.normalise(X.dns(spark, sf_dir)).write.csv(out)
    return readers.csv_records(spark, out)


@query
def csv_dedup(spark, sf_dir):
    return records.distinct_records(csv_files(spark, sf_dir))


# Addresses


@query
def ip_to_long(spark, sf_dir):
    return X.dns(spark, sf_dir).select("seq", I.ip_to_long(F.col("client_ip")).alias("ip"))


@query
def long_to_ip(spark, sf_dir):
    number = F.pmod(F.col("event_id") * 2654435761 + F.col("user_id"), F.lit(1 << 32))
    return X.events(spark, sf_dir).select("event_id", I.long_to_ip(number).alias("ip"))


@query
def cidr_range(spark, sf_dir):
    first, last = I.cidr_range(F.col("cidr"))
    return X.cidr_blocks(spark, sf_dir).select("cidr", first.alias("lo"), last.alias("hi"))


@query
def mask_host_range(spark, sf_dir):
    bits = (8 + F.col("seq") % 23).cast("int")
    mask = I.long_to_ip(F.lit(1 << 32) - I.shift_left(I.big(1), 32 - bits))
    hosts = I.mask_host_range(F.col("client_ip"), F.col("netmask")).alias("hosts")
    return X.dns(spark, sf_dir).withColumn("netmask", mask).select("seq", "netmask", hosts)


@query
def ipv6_hex(spark, sf_dir):
    return X.ipv6_clients(spark, sf_dir).select("event_id", I.ipv6_hex(F.col("client_ip")).alias("hex"))


@query
def ipv6_text(spark, sf_dir):
    short = I.ipv6_text(I.ipv6_hex(F.col("client_ip"))).alias("ip")
    return X.ipv6_clients(spark, sf_dir).select("event_id", short)


@query
def geo_dim_load(spark, sf_dir):
    """Range file written, scanned, turned into segments, stored and read back."""
    folder = work_folder(spark, "geo-file")
    fields = ["ip_start", "ip_end", "country", F.lit("0").alias("unused"), "province", "city", "operator"]
    X.geo_raw(spark, sf_dir).select(*fields).write.csv(folder, sep="|")
    segments = geo.geo_segments(readers.geo_file(spark, folder))
    return geo.save_segments(segments, work_folder(spark, "geo"))


@query
def geo_enrich(spark, sf_dir):
    ods = records.ods_rows(X.dns(spark, sf_dir), keep=["seq"])
    return geo.detail_rows(ods, X.saved_geo(spark, sf_dir), keep=["seq"])


@query
def geo_enrich_asof(spark, sf_dir):
    """The same lookup where the segments of /24 and /16 cells are too many for a broadcast."""
    asked = X.dns(spark, sf_dir).select("seq", "client_ip")
    return geo.locate(asked, X.saved_geo(spark, sf_dir), GEO_LABELS, broadcast_bytes=0)


@query
def geo_enrich_wide(spark, sf_dir):
    """The same with a range over all addresses in the table, which is filed once like any other."""
    asked = X.dns(spark, sf_dir).select("seq", "client_ip")
    segments = geo.save_segments(geo.geo_segments(X.geo_raw_wide(spark, sf_dir)), work_folder(spark, "geo-wide"))
    return geo.locate(asked, segments, GEO_LABELS, broadcast_bytes=0)


@query
def cidr_lookup(spark, sf_dir):
    asked = X.dns(spark, sf_dir).select("seq", "client_ip")
    return cidr.locate_v4(asked, X.cidr_blocks(spark, sf_dir), ["net"], "client_ip")


@query
def cidr_lookup_nearest(spark, sf_dir):
    asked = X.dns(spark, sf_dir).select("seq", "client_ip")
    blocks = X.cidr_blocks(spark, sf_dir)
    return cidr.locate_v4(asked, blocks, ["net"], "client_ip", rule="nearest", inclusive=False)


@query
def cidr6_lookup(spark, sf_dir):
    asked, blocks = X.ipv6_clients(spark, sf_dir), X.cidr6_blocks(spark, sf_dir)
    return cidr.locate_v6(asked, blocks, ["net"], "client_ip")


@query
def cidr_mixed_lookup(spark, sf_dir):
    """Addresses of both kinds in one column, blocks of both kinds in one table."""
    return cidr.locate_block(X.mixed_clients(spark, sf_dir), X.mixed_blocks(spark, sf_dir), ["net"], "client_ip")


# Histograms over busy keys


def prefixes(spark, sf_dir):
    return skew.client_prefixes(X.dns(spark, sf_dir), X.TARGETS, keep=["seq"])


@query
def prefix_counts(spark, sf_dir):
    return skew.prefix_counts(prefixes(spark, sf_dir))


@query
def prefix_counts_salted(spark, sf_dir):
    return skew.salted_prefix_counts(prefixes(spark, sf_dir), ["seq"])


@query
def prefix_map(spark, sf_dir):
    """Maps of about ten entries at most, as many per target as its histogram asks for."""
    maps = skew.prefix_maps(skew.prefix_counts(prefixes(spark, sf_dir)), max_entries=10)
    return _map_text(maps)


def _map_text(maps):
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return maps.select("target_ip", "part", "parts", F.array_join(entries, ", ").alias("counts"))


@query
def prefix_map_merged(spark, sf_dir):
    """Maps made per resolver, then merged entry by entry."""
    rows = X.dns(spark, sf_dir)
    asked = skew.client_prefixes(rows, X.TARGETS, keep=["dns_ip"])
    counted = asked.groupBy("dns_ip", "target_ip", "prefix").agg(F.count(F.lit(1)).alias("n"))
    return skew.merge_maps(skew.prefix_maps(counted, ["dns_ip", "target_ip"]))


@query
def histogram_text(spark, sf_dir):
    maps = skew.prefix_maps(skew.prefix_counts(prefixes(spark, sf_dir)))
    folder = work_folder(spark, "histogram")
    skew.histogram_lines(maps).write.text(folder)
    return readers.text_lines(spark, folder)


@query
def prefix_list(spark, sf_dir):
    """Lists of about 500 items at most, as many per target as its rows ask for."""
    lists = skew.prefix_lists(prefixes(spark, sf_dir), "seq", max_items=500)
    return lists.withColumn("prefixes", F.array_join("prefixes", ","))


@query
def digit_partition(spark, sf_dir):
    placed = skew.place_by_digit(skew.prefix_counts(prefixes(spark, sf_dir)), "target_ip", 4)
    seen = placed.select("target_ip", F.spark_partition_id().alias("partition"), "n")
    return seen.groupBy("target_ip", "partition").agg(
        F.count(F.lit(1)).alias("prefixes"), F.sum("n").alias("requests")
    )


# Windows


@query
def hop_count_top10(spark, sf_dir):
    return windows.bounds_as_text(layers.hop_top_clients(X.dns_lines(spark, sf_dir)))


@query
def hop_count_sql(spark, sf_dir):
    view = f"requests_{uuid.uuid4().hex[:8]}"
    records.parse_delimited_table(X.dns_lines(spark, sf_dir)).createOrReplaceTempView(view)
    return windows.bounds_as_text(windows.hop_counts_sql(spark, view))


@query
def slide_1m_count(spark, sf_dir):
    timed = layers.com_clients(X.dns_lines(spark, sf_dir))
    counts = windows.windowed(timed, "1 minute", "30 seconds")
    return windows.bounds_as_text(windows.top_k(counts, descending=False))


@query
def tumble_count(spark, sf_dir):
    timed = layers.com_clients(X.dns_lines(spark, sf_dir))
    return windows.bounds_as_text(windows.windowed(timed, "2 minutes"))


# Streams


def messages(spark, sf_dir, body="pipe", resend=None, files=None):
    folder, per_chunk = X.staged_messages(spark, sf_dir, body, resend)
    return readers.file_stream(spark, folder, MESSAGE_SCHEMA, files_per_trigger=files or per_chunk)


def checkpoint(spark):
    return work_folder(spark, "progress")


def new_table(label):
    return f"{label}_{uuid.uuid4().hex[:8]}"


def streamed_table(spark, rows, label, partition_by=()):
    """Run a stream to its end into a table and return the table."""
    name = new_table(label)
    sinks.run_to_end(
        sinks.to_table(rows, name, checkpoint(spark), work_folder(spark, label), partition_by)
    )
    return spark.table(name)


@query
def hop_count_top10_stream(spark, sf_dir):
    top = layers.hop_top_clients(messages(spark, sf_dir), watermark="10 seconds")
    out = work_folder(spark, "top10")

    def replace(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/{batch_id}")
        done.append(batch_id)

    done = []
    writer = top.writeStream.outputMode("complete").option("checkpointLocation", checkpoint(spark))
    sinks.run_to_end(sinks.triggered(writer.foreachBatch(replace)).start())
    return windows.bounds_as_text(spark.read.parquet(f"{out}/{max(done)}"))


@query
def hop_count_append(spark, sf_dir):
    timed = layers.com_clients(messages(spark, sf_dir))
    counts = windows.client_window_counts(timed, watermark="10 seconds")
    return windows.bounds_as_text(streamed_table(spark, counts, "hop_append"))


@query
def late_data_dropped(spark, sf_dir):
    """The last chunk sends all failed requests again; those of closed windows are dropped."""
    failed = F.split_part("value", F.lit("|"), F.lit(5)) == "2"
    timed = layers.com_clients(messages(spark, sf_dir, resend=failed))
    counts = windows.client_window_counts(timed, watermark="10 seconds")
    return windows.bounds_as_text(streamed_table(spark, counts, "hop_late"))


@query
def proc_window_sum(spark, sf_dir):
    """Sums over arrival time in update mode; the upsert sink keeps the last sum of a window."""
    rows = records.domain_ends_with(records.parse_records(messages(spark, sf_dir), keep=["seq"]))
    sent = rows.withColumn("sent", F.timestamp_seconds(F.lit(1709251200) + F.expr("seq div 4") * 3))
    return windows.bounds_as_text(arrival_sums(spark, windows.with_arrival_time(sent, transport="sent")))


def arrival_sums(spark, arrived):
    """The sums of a stream over arrival windows, the last one of each window and client."""
    keys = ["window_start", "window_end", "client_ip"]
    out = work_folder(spark, "arrival")
    sums = windows.arrival_window_sums(arrived)
    sinks.run_to_end(upsert.upsert_stream(sums, out, checkpoint(spark), keys, (), "update"))
    return upsert.read_upserts(spark, out, keys)


@query
def arrival_clock_windows(spark, sf_dir):
    """Windows on the clock of the batches. A row is in four of them whenever it comes, which the totals show."""
    rows = records.domain_ends_with(records.parse_records(messages(spark, sf_dir), keep=["seq"]))
    sums = arrival_sums(spark, windows.with_arrival_time(rows))
    return sums.groupBy("client_ip").agg((F.sum("n") / 4).cast("bigint").alias("n"))


@query
def cidr_mixed_stream(spark, sf_dir):
    """The lookup of both kinds of addresses on a stream; the log is not shuffled."""
    folder, per_chunk = X.staged_clients(spark, sf_dir)
    asked = readers.file_stream(spark, folder, "event_id BIGINT, client_ip STRING", files_per_trigger=2 * per_chunk)
    located = cidr.locate_block(asked, X.mixed_blocks(spark, sf_dir), ["net"], "client_ip")
    return streamed_table(spark, located, "mixed")


@query
def stream_rate_limited(spark, sf_dir):
    rows = records.parse_records(messages(spark, sf_dir, files=3), keep=["seq"])
    return streamed_table(spark, rows, "limited")


@query
def stream_table_scan(spark, sf_dir):
    name = new_table("ods")
    sinks.run_to_end(
        layers.ods_load(messages(spark, sf_dir, "json"), name, checkpoint(spark), work_folder(spark, "ods"))
    )
    clients = readers.table_stream(spark, name).select("client_ip")
    return streamed_table(spark, clients, "clients")


@query
def stream_restart(spark, sf_dir):
    """Two runs on one checkpoint, with new messages in between."""
    source, progress, out = (work_folder(spark, n) for n in ("messages", "progress", "restart"))
    name = new_table("restart")
    half = X.CHUNKS // 2
    for chunks in (range(half), range(half, X.CHUNKS)):
        X.write_chunks(spark, sf_dir, source, chunks)
        stream = readers.file_stream(spark, source, MESSAGE_SCHEMA)
        rows = records.parse_records(stream, keep=["seq"])
        sinks.run_to_end(sinks.to_table(rows, name, progress, out, ()))
    return spark.table(name)


@query
def ods_load(spark, sf_dir):
    name = new_table("ods")
    stream = messages(spark, sf_dir, "json")
    sinks.run_to_end(layers.ods_load(stream, name, checkpoint(spark), work_folder(spark, "ods")))
    return spark.table(name)


@query
def demo_load(spark, sf_dir):
    name = new_table("demo")
    stream = messages(spark, sf_dir, "json")
    sinks.run_to_end(
        layers.demo_load(stream, name, checkpoint(spark), work_folder(spark, "demo"), keep=["seq"])
    )
    return spark.table(name)


@query
def rejects_load(spark, sf_dir):
    name = new_table("rejects")
    stream = messages(spark, sf_dir, "json")
    sinks.run_to_end(
        layers.rejects_load(stream, name, checkpoint(spark), work_folder(spark, "rejects"), keep=["seq"])
    )
    return spark.table(name)


@query
def dwd_load(spark, sf_dir):
    ods, dwd = new_table("ods"), new_table("dwd")
    stream = messages(spark, sf_dir, "json")
    sinks.run_to_end(layers.ods_load(stream, ods, checkpoint(spark), work_folder(spark, "ods")))
    segments = X.saved_geo(spark, sf_dir)
    sinks.run_to_end(
        layers.dwd_load(spark, ods, segments, dwd, checkpoint(spark), work_folder(spark, "dwd"))
    )
    return spark.table(dwd)


# Sinks and tables


@query
def insert_select(spark, sf_dir):
    view, table = new_table("source"), new_table("requests")
    X.dns(spark, sf_dir).createOrReplaceTempView(view)
    columns = [c for c in RECORD_FIELDS if c != "time"] + ["time", "hour"]
    catalog.drop_table(spark, table)
    catalog.create_table(
        spark, table, strings(columns), "csv", ["hour"], work_folder(spark, "requests"), {"sep": "|"}
    )
    catalog.insert_select(spark, table, view)
    return spark.table(table)


@query
def table_limit(spark, sf_dir):
    name = new_table("dns")
    X.dns(spark, sf_dir).write.option("path", work_folder(spark, "dns")).format("orc").saveAsTable(name)
    return readers.table_head(spark, name, 3, ["seq"])


@query
def csv_sink(spark, sf_dir):
    out = work_folder(spark, "csv-sink")
    sinks.run_to_end(sinks.to_csv(records.parse_records(messages(spark, sf_dir)), out, checkpoint(spark)))
    return readers.csv_records(spark, out, header=True)


@query
def text_sink(spark, sf_dir):
    rolled, packed = work_folder(spark, "text"), work_folder(spark, "text-packed")
    rows = records.parse_records(messages(spark, sf_dir))
    sinks.run_to_end(sinks.to_text(rows, rolled, checkpoint(spark), max_rows_per_file=1_000_000))
    rolling.roll_text(spark, rolled, packed, idle_seconds=0)
    return rolling.rolled_text(spark, packed)


@query
def text_rolled_twice(spark, sf_dir):
    """A stream that is started twice, its files rolled after each run: the second roll reads only the new ones."""
    source, progress, raw, packed = (work_folder(spark, n) for n in ("messages", "progress", "text", "text-rolled"))
    half = X.CHUNKS // 2
    for chunks in (range(half), range(half, X.CHUNKS)):
        X.write_chunks(spark, sf_dir, source, chunks)
        rows = records.parse_records(readers.file_stream(spark, source, MESSAGE_SCHEMA))
        sinks.run_to_end(sinks.to_text(rows, raw, progress))
        rolling.roll_text(spark, raw, packed, file_bytes=64 * 1024, idle_seconds=0)
    return rolling.rolled_text(spark, packed)


@query
def upsert_latest(spark, sf_dir):
    rows = records.with_id(records.parse_records(messages(spark, sf_dir), keep=["seq"]), keep=["seq"])
    out = work_folder(spark, "upsert")
    sinks.run_to_end(upsert.upsert_stream(rows, out, checkpoint(spark)))
    return upsert.read_upserts(spark, out)


@query
def upsert_compacted(spark, sf_dir):
    """Key/value rows put in several batches, folded into one, then read."""
    rows = records.parse_records(messages(spark, sf_dir), keep=["seq"])
    pairs = rows.select(F.col("client_ip").alias("id"), F.col("domain").alias("value"), "seq")
    out = work_folder(spark, "pairs")
    sinks.run_to_end(upsert.upsert_stream(pairs, out, checkpoint(spark), compact_every=2))
    return upsert.read_upserts(spark, out)


def half_streams(spark, sf_dir, keep=("seq",)):
    """The parsed messages as two streams, one after the other, for queries that run on two checkpoints."""
    half = X.CHUNKS // 2
    for chunks in (range(half), range(half, X.CHUNKS)):
        source = work_folder(spark, "messages")
        files = X.write_chunks(spark, sf_dir, source, chunks)
        yield records.parse_records(readers.file_stream(spark, source, MESSAGE_SCHEMA, files_per_trigger=files), keep=keep)


@query
def upsert_two_runs(spark, sf_dir):
    """Two queries with checkpoints of their own write one keyed table, which is folded in between."""
    out = work_folder(spark, "upsert-runs")
    for rows in half_streams(spark, sf_dir):
        sinks.run_to_end(upsert.upsert_stream(records.with_id(rows, keep=["seq"]), out, checkpoint(spark)))
        upsert.compact_upserts(spark, out)
    return upsert.read_upserts(spark, out)


@query
def partition_commit(spark, sf_dir):
    rows = records.with_event_time(records.parse_records(messages(spark, sf_dir)))
    out = work_folder(spark, "hours")
    sinks.run_to_end(commit.commit_stream(rows, out, checkpoint(spark)))
    return commit.committed_partitions(spark, out).select("dt", "hr", "rows")


@query
def partition_commit_two_runs(spark, sf_dir):
    """A second query with a checkpoint of its own takes over the open hours of the first."""
    out = work_folder(spark, "hours-runs")
    for rows in half_streams(spark, sf_dir, keep=()):
        sinks.run_to_end(commit.commit_stream(records.with_event_time(rows), out, checkpoint(spark)))
    return commit.committed_partitions(spark, out).select("dt", "hr", "rows")


# Keyed tables


def resolver_sets(spark, sf_dir):
    return X.dns(spark, sf_dir).select(F.col("dns_ip").alias("key"), F.col("client_ip").alias("member"), "rcode")


def inserted(spark, sf_dir):
    pairs = resolver_sets(spark, sf_dir)
    return keyed.set_insert(pairs.where("rcode = '0'"), pairs.where("rcode <> '0'"))


@query
def set_insert(spark, sf_dir):
    return inserted(spark, sf_dir)


@query
def set_insert_report(spark, sf_dir):
    return keyed.inserted_keys(inserted(spark, sf_dir))


@query
def table_set_insert(spark, sf_dir):
    """The insert on a stored set: only members it does not hold are written."""
    pairs = resolver_sets(spark, sf_dir)
    table = KeyedTable(spark, work_folder(spark, "set"), ["key", "member"])
    for rows in (pairs.where("rcode = '0'"), pairs.where("rcode <> '0'")):
        table.insert_new(rows.select("key", "member"))
    added = (F.col("_w") == table.last_write()).alias("added")
    return table.read("_w").select("key", "member", added)


@query
def table_delete_keys(spark, sf_dir):
    """Rows by id, without those of ids that were ever corrected, but for what is written after the delete."""
    rows = records.with_id(X.dns(spark, sf_dir), keep=["seq"])
    table = KeyedTable(spark, work_folder(spark, "by-id"))
    table.upsert(rows, ["seq"])
    table.delete(rows.where("rcode = '3'"))
    table.upsert(rows.where("rcode = '3' AND seq % 7 = 2"), ["seq"])
    table.compact()
    return table.read()


@query
def table_delete_fields(spark, sf_dir):
    """Hash fields by key and field, without the fields of requests whose code is not a number."""
    rows = X.dns(spark, sf_dir).select(
        F.col("client_ip").alias("key"), F.col("domain").alias("field"), F.col("seq").alias("value"), "rcode"
    )
    table = KeyedTable(spark, work_folder(spark, "hashes"), ["key", "field"])
    table.upsert(rows.drop("rcode"), ["value"])
    table.delete(rows.where("rcode = 'NA'"))
    return table.read()


@query
def set_members(spark, sf_dir):
    """Domains of all clients that ever got a code that is not a number."""
    rows = X.dns(spark, sf_dir)
    pairs = rows.select(F.col("client_ip").alias("key"), F.col("domain").alias("member"))
    wanted = rows.where("rcode = 'NA'").select(F.col("client_ip").alias("key"))
    return keyed.set_members(pairs, wanted)


@query
def delete_keys(spark, sf_dir):
    """Records without those whose id was ever corrected."""
    rows = records.with_id(X.dns(spark, sf_dir), keep=["seq"])
    return keyed.delete_keys(rows, rows.where("rcode = '3'"), ["id"], salt_by=["seq"])


@query
def delete_fields(spark, sf_dir):
    rows = X.dns(spark, sf_dir).select(
        F.col("client_ip").alias("key"), F.col("domain").alias("field"), "rcode", "seq"
    )
    hashes = rows.groupBy("key", "field").agg(F.max("seq").alias("value"))
    return keyed.delete_fields(hashes, rows.where("rcode = 'NA'"))


# Reports


@query
def domain_mismatch(spark, sf_dir):
    return analysis.domain_mismatch(X.dns(spark, sf_dir))


@query
def rcode_counts(spark, sf_dir):
    return analysis.rcode_counts(X.dns(spark, sf_dir))


@query
def clients_per_resolver(spark, sf_dir):
    return analysis.clients_per_resolver(X.dns(spark, sf_dir))
