"""Column expressions that turn raw message text into record fields."""

from pyspark.sql import functions as F

from logweir.schema import TIME_PATTERN, UNKNOWN_RCODE


def text(value):
    """Message body as text; transports deliver binary."""
    return value.cast("string")


def json_message(value, field="message"):
    """The named string of a JSON body, null where the body is not JSON."""
    return F.get_json_object(text(value), f"$.{field}")


def split_fields(line, delimiter):
    """Fields of a delimited line, with trailing empty fields left out.

    Spark keeps trailing empties, so the trailing delimiters are trimmed first. The escaped
    one-character pattern lets the split run without a regular-expression match per row.
    """
    return F.split(F.rtrim(line, F.lit(delimiter)), "\\" + delimiter if delimiter in "|." else delimiter)


def event_time(time, h12_compat=False):
    """14 digits to a timestamp, null for anything else.

    `h12_compat` gives the reading of a 12-hour pattern: the hour 12 counts as 0.
    """
    parsed = F.when(F.length(time) == 14, F.try_to_timestamp(time, F.lit(TIME_PATTERN)))
    if h12_compat:
        noon = F.substring(time, 9, 2) == "12"
        parsed = F.when(noon, parsed - F.expr("interval 12 hours")).otherwise(parsed)
    return parsed


def time_text(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def date_parts(time):
    """Year, month and day text cut from the 14-digit time."""
    return [
        F.substring(time, 1, 4).alias("year"),
        F.substring(time, 5, 2).alias("month"),
        F.substring(time, 7, 2).alias("day"),
    ]


def composite_id(client_ip, domain, time):
    return F.concat(client_ip, domain, time)


def rcode_number(rcode):
    """Response code as a number; codes that are not numbers become the unknown code."""
    return F.coalesce(rcode.try_cast("int"), F.lit(UNKNOWN_RCODE))


def network_prefix(ip):
    """Text before the last dot, null where there is none."""
    tail = F.substring_index(ip, ".", -1)
    head = F.substring(ip, F.lit(1), F.length(ip) - F.length(tail) - 1)
    return F.when(F.length(head) > 0, head)
