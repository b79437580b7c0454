"""Client addresses as binary keys, computed inside the JVM.

``address_key`` maps an IPv4 or IPv6 text to one version byte (4 or 6) followed by the
big-endian address bytes. In hex digits, the first ``2 + n`` identify the enclosing network of
``4 * n`` bits, so prefix lookups become equality joins on a substring.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_QUAD = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = "^[0-9a-f]{1,4}$"


def _quad_hex(quad: Column) -> Column:
    number = F.lit(0).cast("bigint")
    for i in range(1, 5):
        octet = F.substring_index(F.substring_index(quad, ".", i), ".", -1)
        number = number * 256 + octet.try_cast("bigint")
    return F.lpad(F.hex(number), 8, "0")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _plain_groups(text: Column) -> Column:
    """An embedded IPv4 tail written as the two groups it stands for."""
    with_tail = _bound(
        _quad_hex(F.regexp_extract(text, f"({_QUAD})$", 1)),
        lambda h: F.concat(
            F.regexp_replace(text, f"{_QUAD}$", ""), F.left(h, F.lit(4)), F.lit(":"), F.right(h, F.lit(4))
        ),
    )
    return F.when(text.rlike(f":{_QUAD}$"), F.lower(with_tail)).otherwise(F.lower(text))


def _groups(side: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(side, F.lit("")) == "", none).otherwise(F.split(side, ":"))


def _filled(halves: Column) -> Column:
    """All eight groups: what ``::`` leaves out becomes zeros. NULL for any other shape."""
    left, right = _groups(F.get(halves, F.lit(0))), _groups(F.get(halves, F.lit(1)))

    def fill(sides: Column) -> Column:
        missing = 8 - F.size(sides["left"]) - F.size(sides["right"])
        zeros = F.array_repeat(F.lit("0"), missing)
        shape = ((sides["halves"] == 1) & (missing == 0)) | ((sides["halves"] == 2) & (missing >= 1))
        return F.when(shape, F.concat(sides["left"], zeros, sides["right"]))

    # All of it travels in the struct: Spark takes no lambda that reaches for an outer
    # lambda's variable as input of a Python function.
    sides = F.struct(left.alias("left"), right.alias("right"), F.size(halves).alias("halves"))
    return _bound(sides, fill)


def _v6_hex(text: Column) -> Column:
    groups = _bound(F.split(_plain_groups(text), "::"), _filled)
    return _bound(
        groups,
        lambda gs: F.when(
            F.forall(gs, lambda g: g.rlike(_GROUP)),
            F.array_join(F.transform(gs, lambda g: F.lpad(g, 4, "0")), ""),
        ),
    )


def address_key(text: Column) -> Column:
    """BINARY key of an address text, NULL when the text is no valid address."""
    return F.when(
        text.rlike(f"^{_QUAD}$"), F.unhex(F.concat(F.lit("04"), _quad_hex(text)))
    ).when(F.instr(text, ":") > 0, F.unhex(F.concat(F.lit("06"), _v6_hex(text))))


def digits(text: Column) -> Column:
    """The key as hex digits: two for the version, then the address. NULL like the key."""
    return F.hex(address_key(text))


def network(address: Column, level: int) -> Column:
    """The enclosing network of ``4 * level`` bits, from an address's digits.

    A shorter address gives a shorter text, which equals no network of that level.
    """
    return F.substring(address, 1, 2 + level)
