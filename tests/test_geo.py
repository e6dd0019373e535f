"""Range and block lookups against brute force, on both join paths."""

import ipaddress
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logweir.functions.ip import hex_after, hex_before
from logweir.operators import cidr, geo, segments
from logweir.operators.skew import measured_bytes
from logweir.schema import GEO_LABELS
from logweir.session import ensure_checkpoint_dir

BASE = int(ipaddress.ip_address("10.0.0.0"))


def text(n):
    return str(ipaddress.ip_address(n))


def random_ranges(rng, n, span):
    rows = set()
    for i in range(n):
        lo = rng.randrange(span)
        hi = lo + rng.choice([-3, 0, 1, 5, 40, 300, 5000])
        rows.add((text(BASE + lo), text(max(BASE + hi, 0)), f"c{i % 7}", f"p{i}", f"t{i}", "o"))
    return sorted(rows)


def nearest_end(ranges, ip):
    """Smallest end at or after the address, smallest member on ties; a hit if it starts in time."""
    number = lambda a: int(ipaddress.ip_address(a))
    after = [(number(r[1]), "-".join(r), r) for r in ranges if number(r[1]) >= ip]
    if not after:
        return None
    best = min(after)[2]
    return best[3] if number(best[0]) <= ip else None


@pytest.mark.parametrize("seed,span", [(1, 300), (2, 3000), (3, 200_000)])
def test_range_lookup_is_the_nearest_end_rule(spark, seed, span):
    rng = random.Random(seed)
    ranges = random_ranges(rng, 60, span)
    asked = [text(BASE + rng.randrange(-5, span + 400)) for _ in range(400)] + ["junk", None]
    df = spark.createDataFrame(list(enumerate(asked)), "seq int, client_ip string")
    raw = spark.createDataFrame(ranges, "ip_start string, ip_end string, " + ", ".join(f"{c} string" for c in GEO_LABELS))
    dimension = geo.geo_segments(raw)
    want = {
        i: None if a in ("junk", None) else nearest_end(ranges, int(ipaddress.ip_address(a)))
        for i, a in enumerate(asked)
    }
    for options in ({}, {"broadcast_bytes": 0}):
        got = {r.seq: r.province for r in geo.locate(df, dimension, GEO_LABELS, **options).collect()}
        assert got == want


def test_segments_are_disjoint(spark):
    raw = spark.createDataFrame(
        random_ranges(random.Random(9), 200, 100_000),
        "ip_start string, ip_end string, " + ", ".join(f"{c} string" for c in GEO_LABELS),
    )
    bounds = sorted((r.seg_lo, r.seg_hi) for r in geo.geo_segments(raw).collect())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert all(lo <= hi for lo, hi in bounds)


def test_unreadable_ranges_are_left_out(spark):
    raw = spark.createDataFrame(
        [("x", "10.0.0.9", "c", "p", "t", "o"), ("10.0.0.1", "10.0.0.2", "c", "q", "t", "o")],
        "ip_start string, ip_end string, " + ", ".join(f"{c} string" for c in GEO_LABELS),
    )
    assert [r.province for r in geo.geo_segments(raw).collect()] == ["q"]


def brute_blocks(blocks, ip, inclusive, longest=True):
    address = ipaddress.ip_address(ip)
    hits = []
    for c, net in blocks:
        n = ipaddress.ip_network(c, strict=False)
        if n.version != address.version:
            continue
        first, last = int(n[0]), int(n[-1])
        if longest:
            inside = first <= int(address) <= last if inclusive else first < int(address) < last
            if inside:
                hits.append((-n.prefixlen, f"{c}-{net}", net))
        elif last >= int(address):
            hits.append((last, f"{c}-{net}", net, first))
    if not hits:
        return None
    best = min(hits)
    if longest:
        return best[2]
    _, _, net, first = best
    inside = first <= int(address) <= best[0] if inclusive else first < int(address) < best[0]
    return net if inside else None


def v4_blocks(rng):
    masks = [0, 8, 12, 16, 20, 22, 24, 25, 28, 30, 31, 32]
    return [(f"10.{rng.randrange(3)}.{rng.randrange(8)}.{rng.randrange(256)}/{rng.choice(masks[1:] if i else masks)}", f"n{i}") for i in range(80)]


@pytest.mark.parametrize("rule", ["longest", "nearest"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_v4_blocks(spark, rule, inclusive):
    rng = random.Random(5)
    blocks = v4_blocks(rng) + [("bad/8", "bad"), ("10.0.0.0/40", "bad")]
    good = blocks[:-2]
    asked = [f"10.{rng.randrange(4)}.{rng.randrange(9)}.{rng.choice([0, 1, 7, 128, 255])}" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(asked)), "seq int, client_ip string")
    table = spark.createDataFrame(blocks, "cidr string, net string")
    got = cidr.locate_v4(df, table, ["net"], "client_ip", rule, inclusive)
    want = {i: brute_blocks(good, a, inclusive, rule == "longest") for i, a in enumerate(asked)}
    assert {r.seq: r.net for r in got.collect()} == want


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_mixed_blocks(spark, inclusive, options):
    rng = random.Random(6)
    blocks = v4_blocks(rng)
    for i in range(60):
        g = [0x2001, 0xDB8] + [rng.choice([0, 1, rng.randrange(65536)]) for _ in range(6)]
        length = rng.choice([0, 3, 31, 32, 47, 48, 61, 64, 100, 127, 128])
        blocks.append((":".join(f"{x:x}" for x in g) + f"/{length}", f"six{i}"))
    asked = [f"10.{rng.randrange(3)}.{rng.randrange(8)}.{rng.randrange(256)}" for _ in range(60)]
    for c, _ in blocks[80:]:
        n = ipaddress.ip_network(c, strict=False)
        asked += [str(n[0]), str(n[-1]), str(n[n.num_addresses // 2])]
    df = spark.createDataFrame(list(enumerate(asked)) + [(-1, "junk")], "seq int, client_ip string")
    table = spark.createDataFrame(blocks, "cidr string, net string")
    got = {r.seq: r.net for r in cidr.locate_block(df, table, ["net"], "client_ip", inclusive=inclusive, **options).collect()}
    assert got.pop(-1) is None
    assert got == {i: brute_blocks(blocks, a, inclusive) for i, a in enumerate(asked)}


def test_hex_neighbours(spark):
    numbers = [0, 1, 15, 16, 255, 2**64 - 1, 2**64, 2**127, 2**128 - 2, 2**128 - 1]
    rows = spark.createDataFrame([(f"{n:032x}",) for n in numbers], "h string")
    got = rows.select("h", hex_after(F.col("h")).alias("after"), hex_before(F.col("h")).alias("before")).collect()
    for r in got:
        n = int(r.h, 16)
        assert r.after == (f"{n + 1:032x}" if n < 2**128 - 1 else None)
        assert r.before == (f"{n - 1:032x}" if n else None)


def test_hex_segments_are_disjoint_and_follow_nesting(spark):
    """Nested blocks down to single addresses, up to the whole space, at both ends of it."""
    blocks = [("::/0", "all"), ("2001:db8::/32", "a"), ("2001:db8::/48", "b"), ("2001:db8::/128", "c"), ("2001:db8:0:1::/64", "d"),
              ("ffff::/16", "e"), ("ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff/128", "f"), ("2001:db8::/48", "b2"), ("x/12", "bad")]
    table = spark.createDataFrame(blocks, "cidr string, net string")
    found = sorted((int(r.seg_lo, 16), int(r.seg_hi, 16), r.net) for r in cidr.longest_prefix_hex_segments(table, ["net"]).collect())
    assert found[0][0] == 0 and found[-1][1] == 2**128 - 1
    assert all(a[1] + 1 == b[0] for a, b in zip(found, found[1:]))
    for lo, hi, net in found:
        for n in (lo, hi):
            assert net == brute_blocks(blocks[:-1], str(ipaddress.IPv6Address(n)), True)


def test_a_cell_holds_few_segments(spark):
    """Many single addresses that differ in their last two groups: an address meets 15 candidates per size at most."""
    rng = random.Random(12)
    blocks = [(f"2001:db8::{rng.randrange(4)}:{rng.randrange(65536):x}/128", f"n{i}") for i in range(2000)]
    found = cidr.longest_prefix_hex_segments(spark.createDataFrame(blocks, "cidr string, net string"), ["net"]).collect()
    assert len(found) == len({c for c, _ in blocks})
    table = spark.createDataFrame(found)
    gaps = spark.createDataFrame([(a, b) for a, b in zip(*(sorted(r.seg_lo for r in found)[i:] for i in (0, 1)))], "seg_lo string, after string")
    gaps = gaps.select(hex_after(F.col("seg_lo")).alias("seg_lo"), hex_before(F.col("after")).alias("seg_hi")).where("seg_lo <= seg_hi")
    spans = table.select("seg_lo", "seg_hi").unionByName(gaps)
    filed = segments.filed(spans, segments.v6_cell, segments.V6_CELLS)
    cells = Counter((r.cell_size, r.seg_lo[: r.cell_size]) for r in filed.collect())
    assert max(cells.values()) <= 15


def test_nested_blocks_over_many_ranges(spark, monkeypatch):
    """Each range of edges takes over the blocks that earlier ranges have begun, those that go on over many ranges too."""
    rng = random.Random(13)
    blocks = [("2001:db8::/32", "all"), ("10.0.0.0/8", "ten")]
    for i in range(600):
        at = (0x20010DB8 << 96) + (rng.randrange(1 << 16) << 80)
        blocks.append((f"{ipaddress.IPv6Address(at)}/{rng.choice([33, 36, 40, 43, 48])}", f"six{i}"))
        blocks.append((f"10.{rng.randrange(256)}.{rng.randrange(256)}.0/{rng.choice([9, 12, 16, 20, 24])}", f"four{i}"))
    table = spark.createDataFrame(blocks, "cidr string, net string")
    by_range = type(table).repartitionByRange
    monkeypatch.setattr(type(table), "repartitionByRange", lambda df, *columns: by_range(df, 8, *columns))
    for build, text in ((cidr.longest_prefix_hex_segments, lambda n: str(ipaddress.IPv6Address(int(n, 16)))),
                        (cidr.longest_prefix_segments, lambda n: str(ipaddress.IPv4Address(n)))):
        found = sorted(tuple(r) for r in build(table, ["net"]).collect())
        assert len(found) > 300 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
        for lo, hi, net in found[:: len(found) // 60] + found[-3:]:
            assert brute_blocks(blocks, text(lo), True) == net == brute_blocks(blocks, text(hi), True)


def test_wide_range_is_filed_once(spark):
    raw = spark.createDataFrame(
        [("0.0.0.0", "255.255.255.255", "c", "all", "t", "o"), ("10.0.0.0", "10.0.0.255", "c", "p", "t", "o"),
         ("10.0.255.255", "10.1.0.0", "c", "q", "t", "o")],
        "ip_start string, ip_end string, " + ", ".join(f"{c} string" for c in GEO_LABELS))
    filed = segments.filed(geo.geo_segments(raw), segments.v4_cell, segments.V4_CELLS)
    assert sorted((r.province, r.cell_size) for r in filed.collect()) == [("all", 32), ("p", 8), ("q", 24)]


def test_no_blocks_at_all(spark):
    table = spark.createDataFrame([("x", "n")], "cidr string, net string")
    asked = spark.createDataFrame([(1, "10.0.0.1"), (2, "::1"), (3, None)], "seq int, client_ip string")
    got = cidr.locate_block(asked, table, ["net"], "client_ip").collect()
    assert sorted((r.seq, r.net) for r in got) == [(1, None), (2, None), (3, None)]


def test_followed_values_over_many_ranges(spark):
    rng = random.Random(2)
    numbers = sorted({rng.randrange(10**6) for _ in range(3000)})
    rows = spark.createDataFrame([(n,) for n in numbers + numbers[:50]], "v int")
    ensure_checkpoint_dir(spark)
    got = {r.v: r.after for r in segments.followed(rows, "v").collect()}
    assert got == dict(zip(numbers, numbers[1:] + [None]))


def test_measured_bytes_grows_with_text(spark):
    small = spark.createDataFrame([("a",)], "v string")
    large = spark.createDataFrame([("a" * 1000,)], "v string")
    assert measured_bytes(large) - measured_bytes(small) == 999
