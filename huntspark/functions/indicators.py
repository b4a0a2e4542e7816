"""Indicators of compromise: what a text value is, and which ones a free text holds.

All of it is Spark expressions over whole values; nothing leaves the JVM.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.names import q

# The shapes of a domain, a hash and an address.
DOMAIN = r"^(?!-)[A-Za-z0-9-]{1,63}(?<!-)\.[A-Za-z]{2,}$"
FQDN = r"^((?!-)[A-Za-z0-9-]{1,63}(?<!-)\.)+[A-Za-z]{2,}$"
HASH = r"^([A-Fa-f0-9]{32}|[A-Fa-f0-9]{40}|[A-Fa-f0-9]{64})$"
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_HEXTET = "[0-9A-Fa-f]{1,4}"
_HEXTETS = f"{_HEXTET}(:{_HEXTET})*"

KINDS = ["ip", "domain", "hash"]
_BETWEEN = r"[^0-9A-Za-z.:_%\-\p{L}\p{N}]+"  # what stands between the words of a text
_INSIDE = r"[.:][0-9A-Za-z:_%\-\p{L}\p{N}]"  # a dot or colon that does not end a word


def is_domain(value: Column, fqdn: bool = False) -> Column:
    """``label.tld`` only, as analysts' lists are checked; ``fqdn=True`` also takes more labels."""
    return value.rlike(FQDN if fqdn else DOMAIN)


def is_hash(value: Column) -> Column:
    """MD5, SHA-1 or SHA-256 in hexadecimal."""
    return value.rlike(HASH)


def is_ipv6(value: Column) -> Column:
    """IPv6 text form: eight groups, or fewer around one ``::``; dotted tail and ``%zone`` allowed."""
    address = F.substring_index(value, "%", 1)
    zone_ok = ~F.contains(value, F.lit("%")) | value.rlike("^[^%]+%[^%]+$")
    tail = F.substring_index(address, ":", -1)
    dotted = F.contains(tail, F.lit("."))
    groups = F.when(dotted, F.concat(F.substr(address, F.lit(1), F.length(address) - F.length(tail)),
                                     F.lit("0:0"))).otherwise(address)
    n_groups = F.size(F.filter(F.split(groups, ":"), lambda g: g != ""))
    full = groups.rlike(f"^{_HEXTET}(:{_HEXTET}){{7}}$")
    short = groups.rlike(f"^({_HEXTETS})?::({_HEXTETS})?$") & (n_groups <= 7)
    return F.contains(value, F.lit(":")) & zone_ok & (~dotted | tail.rlike(IPV4)) & (full | short)


def is_ip_address(value: Column) -> Column:
    return value.rlike(IPV4) | is_ipv6(value)


def classify_indicator(value: Column, fqdn: bool = False) -> Column:
    """``hash``, ``domain``, ``ip`` or ``Error``, tried in this order."""
    return (
        F.when(is_hash(value), "hash")
        .when(is_domain(value, fqdn), "domain")
        .when(is_ip_address(value), "ip")
        .otherwise("Error")
    )


def _words(text: Column) -> Column:
    """The words of a text that may hold an indicator: with a dot or colon before more of the word, or as long as a hash. A word
    keeps all letters and digits, dots, colons, hyphens and underscores, so no part of a longer name is taken for a name.

    Plain prose is cut at spaces and tested without patterns, which are slow on it; only what may hold an indicator is cut exactly.
    """
    lots = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    lots = F.filter(lots, lambda w: F.contains(w, F.lit(".")) | F.contains(w, F.lit(":")) | (F.length(w) >= 32))
    likely = F.filter(lots, lambda w: w.rlike(_INSIDE) | (F.length(w) >= 32))
    return F.array_distinct(F.flatten(F.transform(likely, lambda w: F.split(w, _BETWEEN))))


def _addresses(word: Column) -> Column:
    """Readings of a word as an address: without a full stop, without any punctuation at its ends, without a port."""
    bare = F.btrim(word, F.lit(".:-"))
    port = bare.rlike(r"^[^:]+:[0-9]+$")
    return F.array(F.rtrim(word, F.lit(".")), bare, F.when(port, F.substring_index(bare, ":", 1)))


def _is_address(value: Column) -> Column:
    return value.rlike(IPV4) | (F.contains(value, F.lit("::")) | value.rlike("^([^:]*:){7}")) & value.rlike("[0-9A-Fa-f]") & is_ipv6(value)


def _is_host_name(value: Column) -> Column:
    """A host name of any number of labels. The last one is written in one case: in ``end.The`` a sentence ends."""
    return value.rlike(FQDN) & value.rlike(r"\.([a-z]+|[A-Z]+)$") & (F.length(value) <= 253)


def _indicators_of(words: Column, kind: str) -> Column:
    if kind == "ip":
        read = F.transform(words, lambda w: F.get(F.filter(_addresses(w), _is_address), F.lit(0)))
        return F.array_distinct(F.array_compact(read))
    if kind == "domain":
        parts = F.flatten(F.transform(words, lambda w: F.split(w, ":")))
        return F.array_distinct(F.filter(F.transform(parts, lambda p: F.btrim(p, F.lit(".-"))), _is_host_name))
    parts = F.flatten(F.transform(F.filter(words, lambda w: F.length(w) >= 32), lambda w: F.split(w, "[.:_%-]+")))
    return F.array_distinct(F.filter(parts, is_hash))


def extract_indicators(text: Column, kind: str) -> Column:
    """Distinct indicators of one kind (``ip``, ``domain``, ``hash``) in a whole text, as an array; null for a null text.

    The text is cut into whole words first and these are tested, so ``a.b.evil.com`` is one host name, a full stop ends no
    name, and IPv6 addresses are found like others. Ports are left out.
    """
    return _indicators_of(_words(text), kind)


def extract_all_indicators(text: Column) -> Column:
    """All kinds at once, as a struct of arrays; the text is cut into words once."""
    return F.transform(F.array(_words(text)), lambda words: F.struct(*[_indicators_of(words, k).alias(k) for k in KINDS]))[0]


# List predicates -------------------------------------------------------------------------------------------------


def one_of(column: Column, values: list) -> Column:
    return column.isin(list(values))


def none_of(column: Column, values: list) -> Column:
    return ~column.isin(list(values))


_COMPARE = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "CONTAINS": lambda c, v: F.contains(c, F.lit(v)),
}


def any_compare(column: Column, values: list, operator: str = "=") -> Column:
    return reduce(lambda a, b: a | b, [_COMPARE[operator](column, v) for v in values])


def all_compare(column: Column, values: list, operator: str = "=") -> Column:
    return reduce(lambda a, b: a & b, [_COMPARE[operator](column, v) for v in values])


def matches_regex(column: Column, values: list[str], separator: str = "|") -> Column:
    """Any of the values, taken literally, occurs in the column."""
    return column.rlike(separator.join(re.escape(v) for v in values))


def not_matches_regex(column: Column, values: list[str], separator: str = "|") -> Column:
    return ~matches_regex(column, values, separator)


def logical(df: DataFrame, columns: list[str]) -> Column:
    """Distinct non-null values of those of ``columns`` that exist: one logical field over many columns."""
    present = [q(c).cast("string") for c in columns if c in df.columns]
    if not present:
        return F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.array(*present)))


def regex_filter(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(q(column).rlike(pattern))


def event_schema(resource_id: Column) -> Column:
    """Schema name inside an event resource id: ``event://priv:scope.process:...`` style, third part, second word."""
    return F.get(F.split(F.get(F.split(resource_id, ":"), F.lit(2)), r"\."), F.lit(1))
