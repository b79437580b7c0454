"""Log-format specification: an ordered list of field specs.

One spec yields everything a parsing job needs: the anchored regular expression, the
group number of every field, the regex of each leading part of a line (to tell where a
rejected line stops matching) and the result schema. Another nginx layout is another list
of ``Field`` objects; no other code changes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

from hitledger.functions import patterns as P

TYPES = {
    "text": T.StringType(),
    "time": T.TimestampNTZType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "flag": T.BooleanType(),
}


@dataclass(frozen=True)
class Field:
    """One captured field.

    ``body`` mixes regex text and nested fields; regex text holds no capturing groups of
    its own. ``kind`` names the cast rule. ``dash`` lets a literal ``-`` stand for "absent".
    """

    name: str
    body: str | tuple
    kind: str = "text"
    quoted: bool = False
    dash: bool = False

    def walk(self):
        yield self
        if not isinstance(self.body, str):
            for part in self.body:
                if isinstance(part, Field):
                    yield from part.walk()

    def regex(self) -> str:
        parts = (self.body,) if isinstance(self.body, str) else self.body
        text = "".join(p.regex() if isinstance(p, Field) else p for p in parts)
        if self.dash:
            text += "|-"
        text = f"({text})"
        return f'"{text}"' if self.quoted else text


@dataclass(frozen=True)
class Layout:
    """Space-separated ``fields``; the last ``optional_tail`` ones may be absent together."""

    fields: tuple[Field, ...]
    optional_tail: int = 0
    synthesized: tuple[tuple[str, str], ...] = field(default=())

    @cached_property
    def captured(self) -> list[Field]:
        """Every field, nested ones included, in group-number order."""
        return [f for top in self.fields for f in top.walk()]

    @cached_property
    def group_of(self) -> dict[str, int]:
        return {f.name: i for i, f in enumerate(self.captured, start=1)}

    @cached_property
    def regex(self) -> str:
        cut = len(self.fields) - self.optional_tail
        text = " ".join(f.regex() for f in self.fields[:cut])
        if self.optional_tail:
            tail = "".join(" " + f.regex() for f in self.fields[cut:])
            text += f"(?:{tail})?"
        return f"^{text}\\z"

    def leading_regex(self, n: int) -> str:
        """Matches a line whose first ``n`` pieces are well formed."""
        return "^" + " ".join(f.regex() for f in self.fields[:n])

    def with_strict_tail(self) -> Layout:
        return Layout(self.fields, 0, self.synthesized)

    @cached_property
    def schema(self) -> T.StructType:
        columns = [(f.name, f.kind) for f in self.captured] + list(self.synthesized)
        return T.StructType([T.StructField(n, TYPES[k], True) for n, k in columns])


ACCESS_LOG = Layout(
    fields=(
        Field("remote_addr", P.REMOTE_ADDR),
        Field("time_utc", P.BRACKETED_TIME, kind="time"),
        Field(
            "request",
            (
                Field("request_method", P.TOKEN),
                " ",
                Field(
                    "request_url",
                    (
                        Field(
                            "package",
                            (
                                "/package/",
                                Field("package_uuid", P.UUID),
                                "/",
                                Field("package_hash", P.HASH),
                            ),
                        ),
                        "|",
                        Field(
                            "registry",
                            (
                                "/registry/",
                                Field("registry_uuid", P.UUID),
                                "/",
                                Field("registry_hash", P.HASH),
                            ),
                        ),
                        "|",
                        Field("artifact", ("/artifact/", Field("artifact_hash", P.HASH))),
                        "|",
                        P.TOKEN,
                    ),
                ),
                " ",
                Field("request_http", P.HTTP_VERSION),
            ),
            quoted=True,
        ),
        Field("status", P.DIGITS, kind="long"),
        Field("body_bytes_sent", P.DIGITS, kind="long"),
        Field("http_user_agent", P.QUOTED_TEXT, quoted=True),
        Field("request_time", P.DECIMAL, kind="double"),
        Field("julia_version", P.VERSION, dash=True),
        Field("julia_system", P.TOKEN, dash=True),
        Field("julia_ci_variables", P.TOKEN, quoted=True, dash=True),
        Field("julia_interactive", P.TOKEN, kind="flag", dash=True),
        Field("julia_pkg_server", P.TOKEN, quoted=True, dash=True),
        Field("request_id", P.TOKEN, quoted=True, dash=True),
        Field("cache_miss", P.MISS, quoted=True, dash=True),
    ),
    optional_tail=2,
    synthesized=(("pkgserver", "text"), ("hll_hash", "text")),
)
