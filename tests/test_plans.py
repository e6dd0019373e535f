"""What the physical plans must and must not contain."""

import pytest

from logweir.operators import cidr, geo, records
from logweir.registry import fixtures as X
from logweir.registry.queries import QUERIES
from logweir.schema import GEO_LABELS

BATCH = """parse_pipe parse_json parse_csv_ddl ods_rows event_time ip_to_long ipv6_hex geo_enrich
geo_enrich_asof cidr_lookup cidr6_lookup prefix_counts prefix_counts_salted prefix_map prefix_list
hop_count_top10 hop_count_sql tumble_count set_insert set_members delete_keys delete_fields
clients_per_resolver""".split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loop_no_cross_join_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("NestedLoop", "CartesianProduct", "Python", "Pandas", "MapInArrow", "SinglePartition"):
        assert node not in text


def test_scan_reads_only_what_is_used(spark, sf_dir):
    text = plan(X.dns(spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


@pytest.mark.parametrize("body", ["pipe", "json"])
def test_parsing_is_one_stage(spark, sf_dir, body):
    messages = spark.read.parquet(X.staged_messages(spark, sf_dir, body)[0])
    assert "Exchange" not in plan(records.ods_rows(records.parse_records(messages, body)))


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    for name in ("hop_count_top10", "prefix_counts", "rcode_counts", "clients_per_resolver", "csv_dedup"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert text.count("HashAggregate") >= 2 * text.count("Exchange hashpartitioning") > 0


def test_large_dimension_is_not_broadcast(spark, sf_dir):
    asked = X.dns(spark, sf_dir).select("seq", "client_ip")
    segments = X.saved_geo(spark, sf_dir)
    text = plan(geo.locate(asked, segments, GEO_LABELS, broadcast_bytes=0))
    assert "SortMergeJoin" in text and text.count("Generate explode") == plan(asked).count("Generate explode")
    small = plan(geo.locate(asked, segments, GEO_LABELS))
    assert "SortMergeJoin" not in small and "Exchange hashpartitioning" not in small


def test_block_lookups_leave_the_log_where_it_is(spark, sf_dir):
    blocks = X.mixed_blocks(spark, sf_dir)
    text = plan(cidr.locate_block(X.mixed_clients(spark, sf_dir), blocks, ["net"], "client_ip"))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
