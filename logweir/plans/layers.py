"""The jobs put together: raw layer, detail layer and windowed top-k, in batch and in stream."""

from logweir.operators.geo import detail_rows
from logweir.operators.records import (
    demo_rows,
    domain_ends_with,
    ods_rows,
    parse_records,
    rejected_messages,
    with_event_time,
)
from logweir.operators.windows import client_window_counts, top_k
from logweir.sources.readers import table_stream
from logweir.streaming.sinks import to_table


def ods_load(messages, table, checkpoint, path=None, body="json", keep=(), every=None):
    """Messages to the date-partitioned raw table. Works on any stream that has a `value`."""
    rows = ods_rows(parse_records(messages, body, keep=keep), keep)
    return to_table(rows, table, checkpoint, path, every=every)


def rejects_load(messages, table, checkpoint, path=None, body="json", keep=(), every=None):
    """The messages that never reach the raw table, with the reason, in a table of their own."""
    rows = rejected_messages(messages, body, keep=keep, need_date=True)
    return to_table(rows, table, checkpoint, path, partition_by=("reason",), every=every)


def demo_load(messages, table, checkpoint, path=None, body="json", keep=(), every=None):
    """Messages to the date-partitioned demo table: an id of its own and the code as a number."""
    rows = demo_rows(parse_records(messages, body, keep=keep), keep)
    return to_table(rows, table, checkpoint, path, every=every)


def dwd_load(spark, ods_table, segments, table, checkpoint, path=None, keep=(), every=None, **options):
    """Follow the raw table and fill the detail table with located rows."""
    rows = detail_rows(table_stream(spark, ods_table), segments, keep, **options)
    return to_table(rows, table, checkpoint, path, every=every)


def com_clients(messages, body="pipe", h12_compat=False, keep=()):
    """Timed records of the domains the counts are about."""
    return with_event_time(domain_ends_with(parse_records(messages, body, keep=keep)), h12_compat)


def hop_top_clients(messages, k=10, watermark=None):
    """Busiest clients over 2-minute windows every 30 seconds.

    As a stream this needs the complete output mode, whose state is never dropped.
    """
    counts = client_window_counts(com_clients(messages), watermark=watermark)
    return top_k(counts, k)
