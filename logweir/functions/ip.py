"""IPv4, CIDR and IPv6 arithmetic as column expressions.

IPv4 addresses are BIGINT. IPv6 addresses are 32 lower-case hex digits: 2^128-1 does not fit
DECIMAL(38), and the text order of the hex form is the numeric order.
"""

from functools import reduce

from pyspark.sql import functions as F

ALL_ONES = 0xFFFFFFFF


def big(value):
    return F.lit(value).cast("bigint")


def shift_left(value, bits):
    return F.call_function("shiftleft", value, bits.cast("int"))


def ip_to_long(ip):
    """Dotted address to its number, null for text that is not one.

    Only digits and three dots may occur; an empty octet casts to null, which the sum passes on.
    """
    octets = F.split(ip, r"\.")
    parts = [F.get(octets, F.lit(i)).try_cast("bigint") for i in range(4)]
    valid = (F.translate(ip, "0123456789", "") == "...") & (F.greatest(*parts) <= 255)
    return F.when(valid, reduce(lambda acc, p: acc * 256 + p, parts))


def long_to_ip(number):
    a, b, c, d = [F.shiftright(number, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)]
    dot = F.lit(".")
    return F.concat(a, dot, b, dot, c, dot, d)


def cidr_parts(cidr):
    """(address number, mask length), each null if the text is not a valid IPv4 block."""
    pieces = F.split(cidr, "/")
    mask = F.trim(F.get(pieces, F.lit(1))).try_cast("int")
    valid = (F.size(pieces) == 2) & mask.between(0, 32)
    return F.when(valid, ip_to_long(F.get(pieces, F.lit(0)))), F.when(valid, mask)


def cidr_range(cidr):
    """(first, last) address of a block; /0 covers everything and /32 a single address."""
    ip, mask = cidr_parts(cidr)
    size = shift_left(big(1), 32 - mask)
    first = ip - F.pmod(ip, size)
    return first, first + size - 1


def mask_host_range(ip, netmask):
    """Host addresses of a network as `first-->last`, the network given by a dotted mask."""
    mask = ip_to_long(netmask)
    network = ip_to_long(ip).bitwiseAND(mask)
    size = big(ALL_ONES) + 1 - mask
    return F.concat(long_to_ip(network + 1), F.lit("-->"), long_to_ip(network + size - 2))


def ipv6_hex(ip):
    """IPv6 text to 32 hex digits, one `::` expanded; null for text that is not an address.

    Built from few references to its argument: an expression that repeats it would be evaluated
    once per repeat.
    """
    zero, none, gap = F.lit("0"), F.lit(""), F.lit("::")
    edged = F.concat(
        F.when(ip.startswith("::"), zero).otherwise(none), ip, F.when(ip.endswith("::"), zero).otherwise(none)
    )
    # With text on both sides of the gap there are as many groups as colons.
    groups = F.length(edged) - F.length(F.replace(edged, F.lit(":"), none))
    zeros = F.repeat(F.lit("0:"), F.greatest(8 - groups, F.lit(0)))
    full = F.lower(F.replace(edged, gap, F.concat(F.lit(":"), zeros)))
    padded = F.concat(F.lit("000"), F.replace(full, F.lit(":"), F.lit(":000")))
    digits = F.regexp_replace(padded, "0*([0-9a-f]{4})(:|$)", "$1")
    # One gap at most, and between two groups it stands for at least one more.
    sound = ~ip.rlike("::.*::") & (~ip.rlike("^[^:].*::.*[^:]$") | (groups <= 7))
    return F.when(sound & full.rlike("^([0-9a-f]{1,4}:){7}[0-9a-f]{1,4}$"), digits)


def ipv6_text(digits):
    """32 hex digits to text; the first run of two or more zero groups becomes `::`."""
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(F.substring(digits, i * 4 + 1, F.lit(4)), "^0{1,3}", ""))

    def shortened(g):
        marks = F.array_join(F.transform(g, lambda x: F.when(x == "0", "0").otherwise("x")), "")
        run = F.regexp_extract(marks, "00+", 0)
        at = F.locate("00", marks)
        head = F.array_join(F.slice(g, F.lit(1), F.greatest(at - 1, F.lit(0))), ":")
        tail = F.array_join(F.slice(g, F.greatest(at + F.length(run), F.lit(1)), F.lit(8)), ":")
        return F.when(at > 0, F.concat(head, F.lit("::"), tail)).otherwise(F.array_join(g, ":"))

    return F.when(F.length(digits) == 32, F.get(F.transform(F.array(groups), shortened), F.lit(0)))


def hex_bounds(digits, length):
    """First and last address of the network that holds a hex address, for a prefix length."""
    whole = F.floor(length / 4).cast("int")
    rest = (length % 4).cast("int")
    free = F.call_function("shiftleft", F.lit(1), 4 - rest) - 1
    digit = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).try_cast("int")
    network = digit.bitwiseAND(F.lit(15) - free)

    def bound(nibble, fill):
        middle = F.when(rest > 0, F.lower(F.hex(nibble.cast("bigint")))).otherwise(F.lit(""))
        return F.rpad(F.concat(F.substring(digits, F.lit(1), whole), middle), 32, fill)

    return bound(network, "0"), bound(network + free, "f")


def cidr6_parts(cidr):
    """(hex address, prefix length) of an IPv6 block, nulls if the text is not one."""
    pieces = F.split(cidr, "/")
    length = F.trim(F.get(pieces, F.lit(1))).try_cast("int")
    valid = (F.size(pieces) == 2) & length.between(0, 128)
    return F.when(valid, ipv6_hex(F.get(pieces, F.lit(0)))), F.when(valid, length)


def _stepped(digits, full, empty, low, high):
    """A hex address moved by one: the run of `full` digits at its end turns to `empty`, the digit before it moves."""
    stem = F.regexp_replace(digits, f"{full}+$", "")
    moved = F.concat(
        F.substring(stem, F.lit(1), F.length(stem) - 1), F.translate(F.right(stem, F.lit(1)), low, high)
    )
    return F.when(stem != "", F.rpad(moved, 32, empty))


def hex_after(digits):
    """The next hex address; null after the highest one."""
    return _stepped(digits, "f", "0", "0123456789abcde", "123456789abcdef")


def hex_before(digits):
    """The hex address before; null before the lowest one."""
    return _stepped(digits, "0", "f", "123456789abcdef", "0123456789abcde")
