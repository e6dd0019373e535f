"""Location of IPv4 addresses by address range.

The lookup rule is a forward as-of with a range check: of all ranges, the one with the smallest
end at or after the address is tested (the smallest member text breaks ties), and the address is
located if that range also starts at or before it. A wider range behind it is not tried.
`disjoint_segments` turns the ranges into segments that do not overlap and give the same answers,
which makes the lookup an equi-join on address blocks instead of a range join.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from logweir.functions.ip import cidr_range, ip_to_long
from logweir.operators.segments import V4_CELLS, locate_in, v4_cell
from logweir.operators.skew import BROADCAST_BYTES
from logweir.schema import DWD_COLUMNS, GEO_LABELS


def geo_ranges(raw):
    """Address ranges with numeric bounds; rows whose addresses cannot be read are left out."""
    ranges = raw.withColumns(
        {"lo": ip_to_long(F.col("ip_start")), "hi": ip_to_long(F.col("ip_end"))}
    )
    return ranges.where(F.col("lo").isNotNull() & F.col("hi").isNotNull())


def range_member(labels):
    """Text that orders ranges with the same end."""
    return F.concat_ws("-", "ip_start", "ip_end", *[F.coalesce(c, F.lit("")) for c in labels])


def disjoint_segments(ranges, member, labels, inclusive=True):
    """Segments (seg_lo, seg_hi, labels) equal to the nearest-end rule over `ranges`.

    Of ranges with one end only the smallest member counts; each starts no earlier than one past
    the end before it. That end comes from a lag inside a /16 block (at most 65,536 distinct ends)
    and, for the first end of a block, from the last end of the block before, found over the list
    of blocks (at most 65,536 rows). `inclusive=False` leaves both bounds of every range out.
    """
    kept = ranges.groupBy("hi").agg(
        F.min(F.struct(member.alias("_member"), "lo", *labels)).alias("_best")
    )
    kept = kept.select("hi", "_best.lo", *[f"_best.{c}" for c in labels])
    kept = kept.withColumn("_block", F.shiftright("hi", 16))
    blocks = kept.groupBy("_block").agg(F.max("hi").alias("_last"))
    before = blocks.select(
        F.col("_block").alias("_b"), F.lag("_last").over(Window.orderBy("_block")).alias("_before")
    )
    inside = F.lag("hi").over(Window.partitionBy("_block").orderBy("hi"))
    ends = kept.withColumn("_inside", inside).join(
        F.broadcast(before), F.col("_block") == F.col("_b"), "left"
    )
    first_free = F.coalesce("_inside", "_before", F.lit(-1)) + 1
    start, end = (F.col("lo"), F.col("hi")) if inclusive else (F.col("lo") + 1, F.col("hi") - 1)
    return ends.select(
        F.greatest(start, first_free).alias("seg_lo"), end.alias("seg_hi"), *labels
    ).where(F.col("seg_lo") <= F.col("seg_hi"))


def geo_segments(raw):
    """Segments of a geo range table."""
    return disjoint_segments(geo_ranges(raw), range_member(GEO_LABELS), GEO_LABELS)


def cidr_segments(cidrs, labels, inclusive=True):
    """Segments of an IPv4 block table under the nearest-end rule."""
    lo, hi = cidr_range(F.col("cidr"))
    ranges = cidrs.withColumns({"lo": lo, "hi": hi}).where(F.col("hi").isNotNull())
    member = F.concat_ws("-", "cidr", *[F.coalesce(c, F.lit("")) for c in labels])
    return disjoint_segments(ranges, member, labels, inclusive)


def save_segments(segments, path):
    """Store a dimension once, so that jobs read it instead of building it again."""
    segments.write.mode("overwrite").parquet(path)
    return segments.sparkSession.read.parquet(path)


def locate(df, segments, labels, ip="client_ip", broadcast_bytes=BROADCAST_BYTES):
    """`df` with the labels of the segment that holds its address, nulls where there is none.

    For tables and streams. `segments` should be a stored table: it is measured before it is joined.
    """
    return locate_in(df, segments, labels, ip_to_long(F.col(ip)), v4_cell, V4_CELLS, broadcast_bytes)


def detail_rows(ods, segments, keep=(), **options):
    """Detail-layer rows: located, with lower-case domain and authority."""
    lowered = ods.withColumns(
        {"domain": F.lower("domain"), "authority_record": F.lower("authority_record")}
    )
    return locate(lowered, segments, GEO_LABELS, **options).select(*keep, *DWD_COLUMNS)
