import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from logweir.functions import ip as I
from logweir.functions import parsing as P


def apply(spark, fn, texts):
    """fn over a one-column table, in input order."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_split_drops_trailing_empties_only(spark):
    got = apply(spark, lambda v: P.split_fields(v, "|"), ["a|b||", "|a||b", "a,b", "x|y|z"])
    assert got == [["a", "b"], ["", "a", "", "b"], ["a,b"], ["x", "y", "z"]]
    assert apply(spark, lambda v: P.split_fields(v, ","), ["a,b,,"]) == [["a", "b"]]


def test_json_message(spark):
    texts = ['{"message":"a,b"}', "oops", '{"other":1}', None]
    assert apply(spark, P.json_message, texts) == ["a,b", None, None, None]


def test_event_time_and_twelve_hour_reading(spark):
    times = ["20240131123456", "20240131133456", "2024", "20240131253456", "202401311234567", "junk", None]
    as_text = lambda compat: lambda v: P.time_text(P.event_time(v, compat))
    assert apply(spark, as_text(False), times) == [
        "2024-01-31 12:34:56", "2024-01-31 13:34:56", None, None, None, None, None,
    ]
    assert apply(spark, as_text(True), times)[:2] == ["2024-01-31 00:34:56", "2024-01-31 13:34:56"]


def test_rcode_and_prefix(spark):
    assert apply(spark, P.rcode_number, ["0", "2", "NA", "", None]) == [0, 2, 99, 99, 99]
    assert apply(spark, P.network_prefix, ["10.1.2.3", "nodot", ".1", "a.", None]) == [
        "10.1.2", None, None, "a", None,
    ]


def test_ip_numbers(spark):
    good = ["0.0.0.0", "10.0.0.1", "192.168.1.53", "255.255.255.255"]
    numbers = apply(spark, I.ip_to_long, good)
    assert numbers == [int(ipaddress.ip_address(a)) for a in good]
    assert apply(spark, lambda v: I.long_to_ip(v.cast("bigint")), [str(n) for n in numbers]) == good
    bad = ["256.1.1.1", "1.2.3", "1.2.3.4.5", "a.b.c.d", "", "1..2.3", "+1.2.3.4", " 1.2.3.4", None]
    assert apply(spark, I.ip_to_long, bad) == [None] * len(bad)
    assert apply(spark, lambda v: I.long_to_ip(I.ip_to_long(v)), [None]) == [None]


@pytest.mark.parametrize("mask", [0, 1, 8, 27, 31, 32])
def test_cidr_range(spark, mask):
    net = ipaddress.ip_network(f"192.168.1.53/{mask}", strict=False)
    got = apply(spark, lambda v: F.array(*I.cidr_range(v)), [f"192.168.1.53/{mask}"])
    assert got == [[int(net[0]), int(net[-1])]]


def test_cidr_range_refuses(spark):
    bad = ["1.2.3.4/33", "1.2.3.4/-1", "1.2.3.4", "x/8", "1.2.3.4/8/8", None]
    assert apply(spark, lambda v: I.cidr_range(v)[0], bad) == [None] * len(bad)


def test_mask_host_range(spark):
    got = apply(spark, lambda v: I.mask_host_range(v, F.lit("255.255.255.224")), ["192.168.1.53", "x"])
    assert got == ["192.168.1.33-->192.168.1.62", None]


def test_ipv6_against_ipaddress(spark):
    rng = random.Random(3)
    addresses = [ipaddress.IPv6Address(0), ipaddress.IPv6Address(2**128 - 1)]
    for _ in range(300):
        groups = [rng.choice([0, 0, rng.randrange(65536)]) for _ in range(8)]
        addresses.append(ipaddress.IPv6Address(sum(g << (16 * i) for i, g in enumerate(groups))))
    for form in (str, lambda a: a.exploded, lambda a: a.exploded.upper()):
        got = apply(spark, I.ipv6_hex, [form(a) for a in addresses])
        assert got == [f"{int(a):032x}" for a in addresses]
    texts = apply(spark, lambda v: I.ipv6_text(I.ipv6_hex(v)), [str(a) for a in addresses])
    assert [ipaddress.IPv6Address(t) for t in texts] == addresses


def test_ipv6_text_shortens_the_first_run(spark):
    # The usual form shortens the longest run; here it is the first of two or more.
    cases = {"1:0:0:2:0:0:0:3": "1::2:0:0:0:3", "0:0:0:0:0:0:0:0": "::", "1:0:2:3:4:5:6:7": "1:0:2:3:4:5:6:7",
             "0:0:1:2:3:4:5:6": "::1:2:3:4:5:6", "1:2:3:4:5:6:0:0": "1:2:3:4:5:6::"}
    assert apply(spark, lambda v: I.ipv6_text(I.ipv6_hex(v)), list(cases)) == list(cases.values())


def test_ipv6_refuses(spark):
    bad = ["1:2", "1::2::3", "12345::", "g::", "1:2:3:4:5:6:7:8:9", "10.0.0.1", "::ffff:1.2.3.4", "", None]
    assert apply(spark, I.ipv6_hex, bad) == [None] * len(bad)


def test_hex_bounds(spark):
    for length in (0, 1, 4, 47, 64, 127, 128):
        net = ipaddress.ip_network(f"2001:db8:abcd:1234:5678:9abc:def0:1357/{length}", strict=False)
        both = apply(spark, lambda v: F.array(*I.hex_bounds(I.ipv6_hex(v), F.lit(length))),
                     ["2001:db8:abcd:1234:5678:9abc:def0:1357"])
        assert both == [[f"{int(net[0]):032x}", f"{int(net[-1]):032x}"]]


@pytest.mark.parametrize("text", ["a::b::c:d:e:f", "1::2:3:4:5:6:7:8", "::1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7"])
def test_ipv6_gap_must_be_one_and_stand_for_a_group(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(I.ipv6_hex(F.col("t"))).first()[0] is None


@pytest.mark.parametrize("text", ["1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8", "::", "1::"])
def test_ipv6_gap_of_one_group_is_read(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(I.ipv6_hex(F.col("t"))).first()[0]
    assert got == f"{int(ipaddress.ip_address(text)):032x}"
