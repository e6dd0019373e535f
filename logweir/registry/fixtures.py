"""Log messages, address ranges and network blocks derived from the given tables.

Every row of `events` gives one message, some give replays; every row of `customer` gives one
address range and one block of each kind. The rules add the irregularities a log has: replays, late
corrections, short times, missing and extra fields, bad codes and addresses, one busy target.
"""

import math

from pyspark.sql import functions as F

from logweir.operators.geo import geo_segments, save_segments
from logweir.operators.records import parse_records
from logweir.session import pin_utc, work_folder
from logweir.streaming.commit import exists

CHUNKS = 4
ROWS_PER_FILE = 2_000_000
# The targets the prefix histograms are about; the first is the hot one.
TARGETS = ["106.38.176.185", "106.38.176.117", "106.38.176.118", "106.38.176.116"]

# Per event: 0 the message, 1 an exact replay, 2 a correction with another code, 3 a shouted domain.
COPIES = """explode(array_compact(array(0, if(event_id % 50 = 0, 1, null),
    if(event_id % 60 = 0, 2, null), if(event_id % 70 = 2, 3, null))))"""

MESSAGE = {
    "client_ip": """if(event_id % 1009 = 5, 'bad-ip', concat('10.', user_id % 8, '.', event_id % 4 * 4,
        '.', 1 + user_id % 5 * 50))""",
    "domain": """case when copy = 3 then upper(concat(event_type, '.example.com'))
        when event_id % 3 = 0 then concat(event_type, '.example.org')
        when event_id % 3 = 1 then concat(upper(event_type), '.Example.com')
        else concat(event_type, '.example.com') end""",
    "time": """if(event_id % 83 = 0, '2024',
        date_format(timestamp'2024-01-31 12:00:00' + make_dt_interval(0, 0, 0, event_id * 5), 'yyyyMMddHHmmss'))""",
    "target_ip": """case when event_id % 20 = 19 then '203.0.113.9'
        when event_id % 10 < 7 then '106.38.176.185' when event_id % 10 = 7 then '106.38.176.117'
        when event_id % 10 = 8 then '106.38.176.118' else '106.38.176.116' end""",
    "rcode": """case when copy = 2 then '3' when event_id % 103 = 0 then 'NA'
        when event_id % 11 = 0 then '2' else '0' end""",
    "query_type": "'1'",
    "authority_record": """case when event_id % 5 = 0 then '' when event_id % 5 = 1 then 'Other.NET'
        else concat(event_type, '.example.com') end""",
    "add_msg": "if(event_id % 97 = 0, null, '')",
    "dns_ip": "if(event_id % 89 = 0, '', concat('8.8.', user_id % 4, '.8'))",
    "extra": "if(event_id % 101 = 7, 'x', null)",
}


def events(spark, sf_dir):
    return pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type")


def built(df, **columns):
    """Computed columns, each worked out once per row.

    They come out of an inlined one-element array. As plain projections they would be repeated in
    every filter and expression on top of them, which a log read from storage would not be.
    """
    fields = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return df.selectExpr(f"inline(array(named_struct({fields})))")


def lines_of(events_df):
    """Pipe-delimited messages with a sequence number that follows event time."""
    copies = events_df.selectExpr("*", f"{COPIES} AS copy")
    return built(copies, seq="event_id * 4 + copy", value=f"concat_ws('|', {', '.join(MESSAGE.values())})")


def dns_lines(spark, sf_dir):
    return lines_of(events(spark, sf_dir))


def as_json(lines):
    """The same messages as JSON bodies, with some that are not JSON."""
    body = "to_json(named_struct('message', replace(value, '|', ',')))"
    return lines.selectExpr("seq", f"if(seq % 107 = 3, value, {body}) AS value")


def dns(spark, sf_dir):
    """Parsed records with their sequence number."""
    return parse_records(dns_lines(spark, sf_dir), keep=["seq"])


def geo_raw(spark, sf_dir):
    """Overlapping address ranges, one per customer, some unreadable."""
    customers = pin_utc(spark).read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "c_custkey AS k", "c_nationkey", "c_custkey * 97 % 4096 AS o", "c_custkey * 97 % 4096 + c_custkey * 31 % 300 AS t"
    )
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    regions = spark.read.parquet(f"{sf_dir}/region.parquet")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return built(
        joined,
        ip_start="if(k % 211 = 0, 'unknown', concat('10.', k % 9, '.', o div 256, '.', o % 256))",
        ip_end="concat('10.', k % 9, '.', t div 256, '.', t % 256)",
        country="r_name",
        province="n_name",
        city="concat('city_', k % 1000)",
        operator="concat('op_', k % 3)",
    )


def geo_raw_wide(spark, sf_dir):
    """The ranges and one that covers every address."""
    everywhere = spark.range(1).selectExpr(
        "'0.0.0.0' AS ip_start", "'255.255.255.255' AS ip_end", "'ALL' AS country", "'all' AS province",
        "'everywhere' AS city", "'op_all' AS operator"
    )
    return geo_raw(spark, sf_dir).unionByName(everywhere)


def saved_geo(spark, sf_dir):
    """The location dimension, built once and stored."""
    return save_segments(geo_segments(geo_raw(spark, sf_dir)), work_folder(spark, "geo"))


def cidr_blocks(spark, sf_dir):
    """IPv4 blocks of many sizes, one per customer, nested and repeated, some unreadable."""
    return built(
        pin_utc(spark).read.parquet(f"{sf_dir}/customer.parquet"),
        cidr="""case when c_custkey % 223 = 0 then 'x/33' when c_custkey % 199 = 0 then '0.0.0.0/0'
            else concat('10.', c_custkey % 9, '.', c_custkey * 5 % 16, '.', c_custkey * 97 % 256, '/',
            10 + c_custkey % 23) end""",
        net="concat('net_', c_custkey % 1000)",
    )


def cidr6_blocks(spark, sf_dir):
    """IPv6 blocks, with prefix lengths on and off the digit boundaries."""
    return built(
        pin_utc(spark).read.parquet(f"{sf_dir}/customer.parquet"),
        cidr="""concat('2001:db8:', lower(hex(c_custkey % 2000)), '::', lower(hex(c_custkey % 16)), ':0:',
            lower(hex(c_custkey * 7 % 65536)), '/', element_at(
            array(32, 44, 47, 48, 50, 64, 81, 92, 96, 128), cast(c_custkey % 10 + 1 as int)))""",
        net="concat('net_', c_custkey % 1000)",
    )


def ipv6_clients(spark, sf_dir):
    """An IPv6 address per event in three spellings: padded, compressed, upper case."""
    return built(
        events(spark, sf_dir),
        event_id="event_id",
        client_ip="""case when event_id % 1009 = 5 then 'bad-ip'
            when event_id % 3 = 0 then concat('2001:0db8:', lpad(lower(hex(user_id % 65536)), 4, '0'),
                ':0000:0000:', lpad(lower(hex(event_id % 16)), 4, '0'), ':0000:',
                lpad(lower(hex(event_id % 65536)), 4, '0'))
            when event_id % 3 = 1 then concat('2001:db8:', lower(hex(user_id % 65536)), '::',
                lower(hex(event_id % 16)), ':0:', lower(hex(event_id % 65536)))
            else concat('2001:DB8:', hex(user_id % 65536), ':0:0:', hex(event_id % 16), ':0:',
                hex(event_id % 65536)) end""",
    )


def mixed_blocks(spark, sf_dir):
    """Blocks of both kinds in one table."""
    return cidr_blocks(spark, sf_dir).unionByName(cidr6_blocks(spark, sf_dir))


def mixed_clients(spark, sf_dir):
    """An address per event in one column: IPv4 for even events, IPv6 for odd ones."""
    four = built(
        events(spark, sf_dir).where("event_id % 2 = 0"),
        event_id="event_id",
        client_ip="concat('10.', user_id % 8, '.', event_id % 4 * 4, '.', 1 + user_id % 5 * 50)",
    )
    return four.unionByName(ipv6_clients(spark, sf_dir).where("event_id % 2 = 1"))


def chunk_files(spark, rows):
    """Files per chunk: at least one per core, and more once a file would pass ROWS_PER_FILE."""
    return max(2, min(spark.sparkContext.defaultParallelism, 16), math.ceil(rows / CHUNKS / ROWS_PER_FILE))


def write_chunks(spark, sf_dir, folder, chunks, body="pipe", resend=None):
    """Write message files chunk after chunk, so that file times follow event time.

    A chunk is a range of event ids; each gives the same number of files, which is then the intake
    limit that makes one chunk one batch. `resend` picks lines that the last chunk repeats.
    Returns the number of files per chunk.
    """
    base = events(spark, sf_dir)
    low, high, rows = base.agg(F.min("event_id"), F.max("event_id"), F.count(F.lit(1))).first()
    ids, files = high - low + 1, chunk_files(spark, rows)
    for i in chunks:
        # Chunk i holds the ids with (id - low) * CHUNKS // ids == i.
        first, after = low - (-ids * i // CHUNKS), low - (-ids * (i + 1) // CHUNKS)
        lines = lines_of(base.where(F.col("event_id").between(first, after - 1)))
        if resend is not None and i == CHUNKS - 1:
            lines = lines.unionByName(lines_of(base).where(resend))
        lines = as_json(lines) if body == "json" else lines
        message = F.col("value").cast("binary").alias("value")
        lines.select(message, "seq").repartition(files).write.mode("append").parquet(folder)
    return files


_staged = {}


def staged_messages(spark, sf_dir, body="pipe", resend=None):
    """(folder, files per chunk) of the messages for the stream queries, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, body, str(resend))
    if key not in _staged or not exists(spark, _staged[key][0]):
        folder = work_folder(spark, "messages")
        _staged[key] = folder, write_chunks(spark, sf_dir, folder, range(CHUNKS), body, resend)
    return _staged[key]


def staged_clients(spark, sf_dir):
    """(folder, files per chunk) of the mixed addresses, in as many files as the cores and the rows ask for."""
    folder, files = work_folder(spark, "mixed-clients"), chunk_files(spark, events(spark, sf_dir).count())
    mixed_clients(spark, sf_dir).repartition(CHUNKS * files).write.parquet(folder)
    return folder, files
