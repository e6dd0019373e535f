"""Raw messages to named records, with the rejected messages kept on the side.

All transforms here are plain projections and filters, so they run the same on a table and on a
stream and stay inside one generated stage.
"""

from pyspark.sql import functions as F

from logweir.functions import parsing as P
from logweir.schema import ODS_COLUMNS, RECORD_FIELDS, RECORD_SCHEMA

DELIMITER = {"pipe": "|", "json": ","}


def message_text(body, value):
    """Delimited line inside a message: the value itself, or the `message` string of a JSON body."""
    value = F.col(value)
    return P.json_message(value) if body == "json" else P.text(value)


def once(df, keep=(), **columns):
    """`keep` and the given columns, each worked out once per row.

    Behind a one-row array they are not copied into the filters and projections that use them.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))


def named(fields):
    return [F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(RECORD_FIELDS)]


def parse_records(df, body="pipe", value="value", keep=()):
    """Records of the messages that hold exactly nine fields."""
    fields = P.split_fields(message_text(body, value), DELIMITER[body])
    split = once(df, keep, _fields=fields)
    return split.where(F.size("_fields") == len(RECORD_FIELDS)).select(*keep, *named(F.col("_fields")))


def rejected_messages(df, body="pipe", value="value", keep=(), need_date=False):
    """Messages that yield no record, with the reason.

    `need_date` also reports the records the raw layer refuses for a time without a date.
    """
    lines = once(df, keep, value=P.text(F.col(value)), _line=message_text(body, value))
    split = once(lines, [*keep, "value", "_line"], _fields=P.split_fields(F.col("_line"), DELIMITER[body]))
    fields = F.col("_fields")
    reason = F.when(F.col("_line").isNull(), "no message").when(
        F.size(fields) != len(RECORD_FIELDS), "field count"
    )
    if need_date:
        reason = reason.when(F.length(F.get(fields, F.lit(2))) < 8, "short time")
    return once(split, [*keep, "value"], reason=reason).where(F.col("reason").isNotNull())


def parse_delimited_table(df, value="value", keep=(), sep="|"):
    """Records as a delimited table definition reads them, with the computed event time.

    No arity check here: short rows are padded with nulls, long rows cut, empties are null.
    """
    record = F.from_csv(P.text(F.col(value)), RECORD_SCHEMA.simpleString()[7:-1].replace(":", " "), {"sep": sep})
    rows = df.select(*keep, record.alias("_r")).select(*keep, "_r.*")
    return rows.withColumn("event_time", P.event_time(F.col("time")))


def ods_rows(records, keep=()):
    """Raw-layer rows: records whose time holds a date, with its parts as partition columns."""
    dated = records.where(F.length("time") >= 8)
    return dated.select(*keep, *RECORD_FIELDS, *P.date_parts(F.col("time"))).select(*keep, *ODS_COLUMNS)


def demo_rows(records, keep=()):
    """Raw rows with the composite id in front and the response code as a number."""
    key = P.composite_id(F.col("client_ip"), F.col("domain"), F.col("time"))
    return (
        ods_rows(records, keep)
        .withColumn("rcode", P.rcode_number(F.col("rcode")))
        .select(*keep, key.alias("id"), *ODS_COLUMNS)
    )


def with_id(records, keep=()):
    key = P.composite_id(F.col("client_ip"), F.col("domain"), F.col("time"))
    return records.select(*keep, key.alias("id"), *RECORD_FIELDS)


def index_rows(records, keep=()):
    """Records as the search index takes them: id first, `time` under its index name."""
    return with_id(records, keep).withColumnRenamed("time", "do_time")


def normalise(records, keep=()):
    """Lower-case the domains; missing authority and message become empty."""
    clean = {
        "domain": F.lower("domain"),
        "authority_record": F.lower(F.coalesce("authority_record", F.lit(""))),
        "add_msg": F.coalesce("add_msg", F.lit("")),
    }
    return records.select(*keep, *[clean.get(c, F.col(c)).alias(c) for c in RECORD_FIELDS])


def distinct_records(records):
    """Normalised records without repeats, over the whole table rather than per partition."""
    return normalise(records).dropDuplicates()


def domain_ends_with(records, suffix="com"):
    return records.where(F.col("domain").endswith(suffix))


def with_event_time(records, h12_compat=False):
    """Adds the event time; rows whose time cannot be read are left out."""
    timed = once(records.drop("event_time"), ["*"], event_time=P.event_time(F.col("time"), h12_compat))
    return timed.where(F.col("event_time").isNotNull())
