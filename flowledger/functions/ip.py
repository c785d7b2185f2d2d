"""Canonical text of IP addresses with built-in string functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_OCTET = r"0{0,2}(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})"
_PLAIN_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_PLAIN_IPV4 = rf"^{_PLAIN_OCTET}\.{_PLAIN_OCTET}\.{_PLAIN_OCTET}\.{_PLAIN_OCTET}$"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
_IPV4_TAIL = rf"^([0-9a-f:]*:)({_OCTET})\.({_OCTET})\.({_OCTET})\.({_OCTET})$"
_EIGHT_GROUPS = r"^[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){7}$"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair_to_group(text: Column, high: int, low: int) -> Column:
    """Two decimal octets of an address tail as one hexadecimal group."""
    octet = lambda group: F.regexp_extract(text, _IPV4_TAIL, group).cast("int")
    return F.lower(F.hex(octet(high) * 256 + octet(low)))


def _group_to_pair(group: Column) -> Column:
    """One hexadecimal group as two decimal octets ``a.b``."""
    return _let(
        F.conv(group, 16, 10).cast("int"),
        lambda number: F.concat_ws(".", F.shiftright(number, 8).cast("string"), number.bitwiseAND(255).cast("string")),
    )


def _without_dotted_tail(text: Column) -> Column:
    """``1:2::3.4.5.6`` with its tail as two hexadecimal groups."""
    hexed = F.concat(
        F.regexp_extract(text, _IPV4_TAIL, 1),
        _pair_to_group(text, 2, 3),
        F.lit(":"),
        _pair_to_group(text, 4, 5),
    )
    return F.when(F.contains(text, F.lit(".")), F.when(text.rlike(_IPV4_TAIL), hexed)).otherwise(text)


def _written_out(text: Column) -> Column:
    """``::`` replaced by the zero groups it stands for."""
    missing = 8 - F.regexp_count(text, F.lit("[0-9a-f]+"))
    filled = F.replace(text, F.lit("::"), F.concat(F.repeat(F.lit(":0"), missing), F.lit(":")))
    outer_colons = F.when(F.startswith(text, F.lit("::")), 1).otherwise(0) + F.when(
        F.endswith(text, F.lit("::")), 1
    ).otherwise(0)
    from_first = F.when(F.startswith(text, F.lit("::")), 2).otherwise(1)
    inner = F.substring(filled, from_first, F.length(filled) - outer_colons)
    return F.when(F.contains(text, F.lit("::")), F.when(missing > 0, inner)).otherwise(text)


def _without_leading_zeros(groups: Column) -> Column:
    """Eight groups without leading zeros; NULL when the text is not eight groups."""
    return F.when(groups.rlike(_EIGHT_GROUPS), F.regexp_replace(groups, "(^|:)0+(?=[0-9a-f])", "$1"))


def _compress(groups: Column) -> Column:
    """Shortest form: the first longest run of two or more zero groups becomes ``::``."""
    fenced = F.concat(F.lit(":"), groups, F.lit(":"))
    shortest = groups
    for run in range(2, 9):
        zeros = ":" + "0:" * run
        at = F.instr(fenced, zeros)
        before = F.substring(fenced, F.lit(2), at - 2)
        after = F.substring(fenced, at + len(zeros), F.length(fenced) - at - len(zeros))
        # the inner branch holds the shorter runs, so the longest one wins
        shortest = F.when(at > 0, F.concat(before, F.lit("::"), after)).otherwise(shortest)
    tail = F.concat_ws(
        ".",
        _group_to_pair(F.get(F.split(groups, ":"), F.lit(6))),
        _group_to_pair(F.get(F.split(groups, ":"), F.lit(7))),
    )
    # ::/96 and ::ffff:0:0/96 are written with a dotted tail
    return (
        F.when(F.startswith(groups, F.lit("0:0:0:0:0:ffff:")), F.concat(F.lit("::ffff:"), tail))
        .when(groups.rlike("^(?:0:){6}(?!0:)"), F.concat(F.lit("::"), tail))
        .otherwise(shortest)
    )


def _canonical_ipv6(text: Column) -> Column:
    for step in (_without_dotted_tail, _written_out, _without_leading_zeros, _compress):
        text = _let(text, step)
    return text


def canonical_ip(text: Column) -> Column:
    """IPv6 text form of an address; IPv4 becomes ``::ffff:a.b.c.d``; NULL when it is no address."""
    zero_padded = F.when(text.rlike(_IPV4), F.regexp_replace(text, r"\b0{1,2}(?=\d)", ""))
    ipv4 = F.concat(F.lit("::ffff:"), F.when(text.rlike(_PLAIN_IPV4), text).otherwise(zero_padded))
    return F.when(F.contains(text, F.lit(":")), _canonical_ipv6(F.lower(text))).otherwise(ipv4)
