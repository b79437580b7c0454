"""Privacy: drop addresses, or mask addresses, hashes and times inside log text.

Masking runs in Arrow batches, one pass of a regular expression per kind of value. Each match is
replaced by a value drawn from a keyed digest, remembered per task, as the same client fills many
lines. "Random" replacements come from a digest too, of the seed, the line's identity, the pass and
the position of the match; so a retried task, or another partitioning, writes the same text. The key
travels inside the function, not as an expression, so no plan or event log shows it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions import patterns as P

ADDRESS_COLUMN = "remote_addr"


def without_address(rows: DataFrame) -> DataFrame:
    return rows.drop(ADDRESS_COLUMN)


def resource_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.where(F.col(line).rlike(P.RESOURCE_PATHS))


# --- replacement values, each from a 64-digit hex digest --------------------------------


def fake_ipv4(digest: str) -> str:
    return ".".join(str(int(digest[i : i + 2], 16)) for i in range(0, 8, 2))


def fake_ipv6(digest: str) -> str:
    return ":".join(digest[i : i + 4].lstrip("0") or "0" for i in range(0, 32, 4))


def fake_hash(digest: str) -> str:
    return digest[:40]


_START = datetime.fromisoformat(P.MASKED_FROM)


def _fake_moment(digest: str) -> datetime:
    return _START + timedelta(seconds=int(digest[:13], 16) % (P.MASKED_DAYS * 24 * 60 * 60))


def fake_local_time(digest: str) -> str:
    return _fake_moment(digest).strftime("%d/%b/%Y:%H:%M:%S")


def fake_iso_time(digest: str) -> str:
    return _fake_moment(digest).strftime("%Y-%m-%dT%H:%M:%S")


@dataclass(frozen=True)
class Kind:
    """What one pass replaces, by what, and a cheap test that every such text passes."""

    name: str
    pattern: str
    fake: Callable[[str], str]
    maybe: Callable[[str], object]


_SEVEN_GROUPS = re.compile("(?:[0-9a-fA-F]{1,4}:){7}")


def _maybe_ipv6(text: str) -> object:
    # every form has a double colon, or seven groups, or is a zoned link-local address
    return "::" in text or "fe80:" in text or _SEVEN_GROUPS.search(text)


# Eight groups, or fewer around a double colon; then whatever else belongs to an address: more groups,
# or the other three numbers of an IPv4 tail. A link-local address may consist of its zone.
_GROUP = "[0-9a-fA-F]{1,4}"
_SOME = f"{_GROUP}(?::{_GROUP}){{0,6}}"
_WHOLE_IPV6 = rf"(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_SOME})?::(?:{_SOME})?)[0-9a-fA-F:]*(?:\.[0-9]+){{0,3}}|fe80:%[0-9a-zA-Z]+"

HASHES = Kind("hash", P.HASH, fake_hash, lambda text: len(text) >= 40)
IPV4 = Kind("ipv4", P.IPV4, fake_ipv4, lambda text: text.count(".") >= 3)
IPV6 = Kind("ipv6", _WHOLE_IPV6, fake_ipv6, _maybe_ipv6)
LOCAL = Kind("local_time", P.LOCAL_TIME_IN_TEXT, fake_local_time, lambda text: text.count("/") >= 2)
ISO = Kind("iso_time", P.ISO_TIME_IN_TEXT, fake_iso_time, lambda text: "T" in text)

# Order matters: an IPv4 tail belongs to its IPv6 address.
PASSES = [IPV6, IPV4, HASHES, LOCAL, ISO]
#: Replacements a task remembers for each kind before it starts anew.
REMEMBERED = 200_000


class _Masker:
    """Masks texts with one key; made once per batch stream, so what it remembers is bounded."""

    def __init__(self, key: str, kinds: Sequence[Kind], random_share: float, seed: str):
        self.key, self.share, self.seed = key, random_share, seed
        # letters and digits are ASCII, as in the log format
        self.passes = [(kind, re.compile(kind.pattern, re.ASCII)) for kind in kinds]
        self.known: dict[str, dict[str, str]] = {kind.name: {} for kind in kinds}

    def _digest(self, *parts: str) -> str:
        return hashlib.sha256("\0".join((self.key, *parts)).encode()).hexdigest()

    def linked(self, match: str, kind: Kind) -> str:
        """The value that stands for a match wherever it occurs."""
        known = self.known[kind.name]
        fake = known.get(match)
        if fake is None:
            if len(known) >= REMEMBERED:
                known.clear()
            fake = known[match] = kind.fake(self._digest(kind.name, match))
        return fake

    def masked(self, text: str, identity: str = "") -> str:
        for kind, pattern in self.passes:
            if kind.maybe(text):
                text = self._one_pass(text, kind, pattern, identity)
        return text

    def _one_pass(self, text: str, kind: Kind, pattern: re.Pattern, identity: str) -> str:
        place = -1

        def replaced(match: re.Match) -> str:
            nonlocal place
            place += 2
            if self.share > 0:
                drawn = self._digest(self.seed, kind.name, identity, str(place))
                # the last 13 digits decide, the first ones make the value
                if int(drawn[51:], 16) / 16**13 < self.share:
                    return kind.fake(drawn)
            return self.linked(match[0], kind)

        return pattern.sub(replaced, text)


def _checked(key: str) -> str:
    if not key:
        raise ValueError("masking needs a secret key")
    return key


def _text_masker(key: str, kinds: Sequence[Kind], random_share: float, seed: str):
    """Column function: (text, identity) -> masked text; null stays null."""
    masker = _Masker(key, kinds, random_share, seed)

    @F.arrow_udf("string")
    def mask_text(texts: pa.Array, identities: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), identities.to_pylist())
        return pa.array([None if t is None else masker.masked(t, i) for t, i in pairs], pa.string())

    return mask_text


def _pseudonym(key: str):
    """Column function: (value, kind's name) -> its keyed stand-in; null stays null."""
    kinds = {kind.name: kind for kind in PASSES}
    masker = _Masker(key, PASSES, 0.0, "")

    @F.arrow_udf("string")
    def pseudonym(values: pa.Array, names: pa.Array) -> pa.Array:
        pairs = zip(values.to_pylist(), names.to_pylist())
        return pa.array([None if v is None else masker.linked(v, kinds[n]) for v, n in pairs], pa.string())

    return pseudonym


def mask_lines(
    lines: DataFrame,
    key: str,
    line: str = "value",
    identity: Sequence[str] = (),
    random_share: float = P.MASK_RANDOM_SHARE,
    seed: str = "",
) -> DataFrame:
    """Masks every address, 40-digit hash and time in ``line``, in pass order.

    ``identity`` names columns that tell lines apart (file, line number, event id); without
    it the original text itself is used, so equal lines draw alike.
    """
    _checked(key)
    told_apart = [F.col(c).cast("string") for c in identity] or [F.col(line)]
    own = F.sha2(F.concat_ws("\0", *told_apart), 256)
    return lines.withColumn(line, _text_masker(key, PASSES, random_share, seed)(F.col(line), own))


def mask_columns(rows: DataFrame, key: str) -> DataFrame:
    """Parsed rows with addresses and content hashes replaced by keyed pseudonyms.

    The hashes inside URLs get the same pseudonyms as the hash columns.
    """
    _checked(key)
    pseudonym, rewritten = _pseudonym(key), _text_masker(key, [HASHES], 0.0, "")
    columns: dict[str, Column] = {
        n: pseudonym(F.col(n), F.lit(HASHES.name)) for n in ("package_hash", "registry_hash", "artifact_hash")
    }
    columns |= {n: rewritten(F.col(n), F.lit("")) for n in ("request", "request_url", "package", "registry", "artifact")}
    family = F.when(F.instr(ADDRESS_COLUMN, ":") > 0, IPV6.name).otherwise(IPV4.name)
    columns[ADDRESS_COLUMN] = pseudonym(F.col(ADDRESS_COLUMN), family)
    return rows.withColumns({n: c for n, c in columns.items() if n in rows.columns})
