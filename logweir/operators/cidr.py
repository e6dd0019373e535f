"""Address lookup in tables of network blocks (`ip/mask`), IPv4 and IPv6."""

from pyspark.sql import functions as F

from logweir.functions.ip import (
    ALL_ONES,
    cidr6_parts,
    cidr_parts,
    cidr_range,
    hex_after,
    hex_before,
    hex_bounds,
    ipv6_hex,
)
from logweir.operators.geo import cidr_segments, locate
from logweir.operators.segments import V6_CELLS, innermost_segments, locate_in, v6_cell, worked_out
from logweir.operators.skew import BROADCAST_BYTES
from logweir.session import ensure_checkpoint_dir


def _smallest(blocks, keys, labels):
    """One row per network: the smallest member text where labels differ."""
    member = F.concat_ws("-", "cidr", *[F.coalesce(c, F.lit("")) for c in labels])
    best = F.min(F.struct(member.alias("_member"), *labels)).alias("_best")
    return blocks.groupBy(*keys).agg(best).select(*keys, *[f"_best.{c}" for c in labels])


def longest_prefix_segments(cidrs, labels, inclusive=True):
    """Disjoint segments that give each address the labels of its most specific IPv4 block.

    Log rows later pay the lookup of a segment, whatever the number of mask lengths.
    """
    ensure_checkpoint_dir(cidrs.sparkSession)
    lo, hi = cidr_range(F.col("cidr"))
    _, mask = cidr_parts(F.col("cidr"))
    read = worked_out(cidrs, _lo=lo, _hi=hi, _len=mask).where(F.col("_hi").isNotNull())
    blocks = _smallest(read, ["_len", "_lo", "_hi"], labels)
    edge = 0 if inclusive else 1
    blocks = blocks.withColumns({"_first": F.col("_lo") + edge, "_last": F.col("_hi") - edge})
    blocks = blocks.where(F.col("_first") <= F.col("_last")).checkpoint()

    return innermost_segments(blocks, labels, lambda x: x + 1, lambda x: x - 1, ALL_ONES)


def locate_v4(df, cidrs, labels, ip, rule="longest", inclusive=True, **options):
    """Labels of the IPv4 block of each address: the most specific one, or by nearest end."""
    build = {"longest": longest_prefix_segments, "nearest": cidr_segments}[rule]
    ensure_checkpoint_dir(df.sparkSession)
    return locate(df, build(cidrs, labels, inclusive=inclusive).checkpoint(), labels, ip, **options)


def longest_prefix_hex_segments(cidrs, labels, inclusive=True):
    """Disjoint hex segments that give each address the labels of its most specific IPv6 block."""
    ensure_checkpoint_dir(cidrs.sparkSession)
    digits, length = cidr6_parts(F.col("cidr"))
    read = worked_out(cidrs, _digits=digits, _len=length).where(F.col("_digits").isNotNull())
    first, last = hex_bounds(F.col("_digits"), F.col("_len"))
    blocks = _smallest(worked_out(read, _net=first, _end=last), ["_len", "_net", "_end"], labels)
    edges = (F.col("_net"), F.col("_end")) if inclusive else (hex_after(F.col("_net")), hex_before(F.col("_end")))
    blocks = blocks.withColumns({"_first": edges[0], "_last": edges[1]})
    blocks = blocks.where(F.col("_first") <= F.col("_last")).checkpoint()

    return innermost_segments(blocks, labels, hex_after, hex_before, "f" * 32)


def locate_v6(df, cidrs, labels, ip, inclusive=True, broadcast_bytes=BROADCAST_BYTES):
    """Labels of the most specific IPv6 block of each address of a table or stream."""
    segments = longest_prefix_hex_segments(cidrs, labels, inclusive).checkpoint()
    return locate_in(df, segments, labels, ipv6_hex(F.col(ip)), v6_cell, V6_CELLS, broadcast_bytes)


def locate_block(df, cidrs, labels, ip, **options):
    """Lookup of mixed addresses: those with a colon in the IPv6 blocks, the others in the IPv4 ones.

    For tables and streams; `options` go to both lookups.
    """
    is_v6 = F.col("cidr").contains(":")
    four = locate_v4(df, cidrs.where(~is_v6), labels, ip, **options)
    four = four.withColumnsRenamed({c: f"_4_{c}" for c in labels})
    both = locate_v6(four, cidrs.where(is_v6), labels, ip, **options)
    return both.select(*df.columns, *[F.coalesce(f"_4_{c}", c).alias(c) for c in labels])
