from conftest import values

from logweir.operators import records
from logweir.schema import DWD_COLUMNS, RECORD_FIELDS

FULL = "10.0.0.1|A.com|20240131120005|1.1.1.1|0|1|B.COM|msg|8.8.8.8"


def lines(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq bigint, value string")
    return df.selectExpr("seq", "cast(value as binary) value")


def test_only_nine_fields_pass(spark):
    no_server = FULL.rsplit("|", 1)[0] + "|"
    df = lines(spark, FULL, FULL + "|x", no_server, "a|b", None)
    assert [r.seq for r in records.parse_records(df, keep=["seq"]).collect()] == [0]
    assert values(records.rejected_messages(df, keep=["seq"]).select("seq", "reason")) == [
        (1, "field count"), (2, "field count"), (3, "field count"), (4, "no message"),
    ]


def test_rows_and_rejects_are_complete(spark):
    short = FULL.replace("20240131120005", "2024")
    bodies = [f'{{"message":"{t.replace("|", ",")}"}}' for t in (FULL, short, "a|b")] + ["junk"]
    df = lines(spark, *bodies)
    kept = records.ods_rows(records.parse_records(df, "json", keep=["seq"]), ["seq"])
    lost = records.rejected_messages(df, "json", keep=["seq"], need_date=True)
    assert values(kept.select("seq", "year", "month", "day")) == [(0, "2024", "01", "31")]
    assert values(lost.select("seq", "reason")) == [(1, "short time"), (2, "field count"), (3, "no message")]


def test_delimited_table_pads_and_cuts(spark):
    df = lines(spark, "1.1.1.1|a", FULL + "|extra", '"x|y"|b')
    rows = {r.seq: r for r in records.parse_delimited_table(df, keep=["seq"]).collect()}
    assert rows[0].domain == "a" and rows[0].dns_ip is None and rows[0].event_time is None
    assert rows[1].dns_ip == "8.8.8.8" and str(rows[1].event_time) == "2024-01-31 12:00:05"
    assert rows[2].client_ip == "x|y"


def test_normalise_and_distinct(spark):
    row = ("1", "A.Com", "t", "2", "0", "1", None, None, "8")
    df = spark.createDataFrame([row, ("1", "a.com", "t", "2", "0", "1", "", "", "8")], ", ".join(f"`{c}` string" for c in RECORD_FIELDS))
    assert values(records.distinct_records(df)) == [("1", "a.com", "t", "2", "0", "1", "", "", "8")]


def test_demo_and_index_layouts(spark):
    parsed = records.parse_records(lines(spark, FULL))
    demo = records.demo_rows(parsed)
    assert demo.columns[0] == "id" and dict(demo.dtypes)["rcode"] == "int"
    assert demo.first().id == "10.0.0.1A.com20240131120005"
    assert records.index_rows(parsed).columns[:4] == ["id", "client_ip", "domain", "do_time"]
    assert len(DWD_COLUMNS) == 16


def test_messages_are_parsed_once(spark):
    """Filters and projections name the parsed columns; they do not carry the parsing along."""
    messages = spark.createDataFrame([("{}",)], "value string").repartition(2)

    def counts(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("split("), plan.count("get_json_object("), plan.count("try_to_timestamp(") + plan.count("gettimestamp(")

    parsed = records.parse_records(messages, "json")
    assert counts(records.ods_rows(parsed)) == (1, 1, 0)
    assert counts(records.rejected_messages(messages, "json", need_date=True)) == (1, 1, 0)
    assert counts(records.with_event_time(parsed)) == (1, 1, 1)
