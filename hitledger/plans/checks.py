"""The catalogue's checking SQL: the same questions, asked of the same tables in DuckDB.

The log lines are built by the shared text of ``sample_log``; everything after that is
written for the other engine from the log contract, with its own regular expressions.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
from datetime import date, timedelta

from hitledger.functions import patterns as P
from hitledger.plans.sample_log import CI_PREFIXES, MASK_KEY, lines_sql, registries_sql

_HEX = "[a-fA-F0-9]"
_UUID = f"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
_HASH = f"{_HEX}{{40}}"
# leading pieces of a line, in order, for the place where a rejected line stops matching
_PIECES = [
    ("remote_addr", r"([\.a-fA-F0-9:]+)"),
    ("time_utc", r" (\[.*?\])"),
    (
        "request",
        rf' "(([^ ]+) ((/package/({_UUID})/({_HASH}))|(/registry/({_UUID})/({_HASH}))'
        rf'|(/artifact/({_HASH}))|[^ ]+) (HTTP/[\.\d]+))"',
    ),
    ("status", r" (\d+)"),
    ("body_bytes_sent", r" (\d+)"),
    ("http_user_agent", r' "(.+?)"'),
    ("request_time", r" ([\.\d]+)"),
    ("julia_version", r" (\d+\.[^ ]+|-)"),
    ("julia_system", r" ([^ ]+|-)"),
    ("julia_ci_variables", r' "([^ ]+|-)"'),
    ("julia_interactive", r" ([^ ]+|-)"),
    ("julia_pkg_server", r' "([^ ]+|-)"'),
    ("request_id", r' "([^ ]+|-)"'),
    ("cache_miss", r' "(miss|-)"'),
]
_NAMES = [
    "remote_addr", "time_text", "request", "request_method", "request_url", "package",
    "package_uuid", "package_hash", "registry", "registry_uuid", "registry_hash", "artifact",
    "artifact_hash", "request_http", "status_text", "bytes_text", "http_user_agent",
    "request_time_text", "julia_version", "julia_system", "julia_ci_variables", "flag_text",
    "julia_pkg_server", "request_id", "cache_miss",
]
_FULL = "^" + "".join(p for _, p in _PIECES) + "$"
_SERVER = r"nullif(regexp_extract(src_file, '^access_(.*)\.pkg\.julia', 1), '')"

_TEXT = [n for n in _NAMES if not n.endswith("_text")]
_ROWS = f"""
lines as ({lines_sql()}),
captured as materialized (
  select event_id, src_file, line,
         regexp_extract(line, '{_FULL}', [{", ".join(f"'{n}'" for n in _NAMES)}]) as c
  from lines where regexp_matches(line, '{_FULL}')),
clocked as (
  select *, c.time_text as tt,
         case when c.time_text like '%/%' then try_strptime(substr(c.time_text, 2, 20), '%d/%b/%Y:%H:%M:%S')
              else try_strptime(substr(c.time_text, 2, 19), '%Y-%m-%dT%H:%M:%S') end as wall,
         replace(replace(right(c.time_text, 7), ':', ''), ' ', '') as zone
  from captured),
parsed as (
  select event_id, src_file,
         {", ".join(f"nullif(nullif(c.{n}, ''), '-') as {n}" for n in _TEXT)},
         wall - to_minutes(cast(concat(substr(zone, 1, 1), '1') as bigint)
                * (60 * cast(substr(zone, 2, 2) as bigint) + cast(substr(zone, 4, 2) as bigint))) as time_utc,
         try_cast(c.status_text as bigint) as status,
         try_cast(c.bytes_text as bigint) as body_bytes_sent,
         try_cast(c.request_time_text as double) as request_time,
         case c.flag_text when 'true' then true when '1' then true when 'false' then false
                          when '0' then false end as julia_interactive,
         {_SERVER} as pkgserver
  from clocked)"""

_ADDRESS = """
addressed as (
  select *, case when remote_addr not like '%:%' then
           cast(split_part(remote_addr, '.', 1) as bigint) * 16777216
         + cast(split_part(remote_addr, '.', 2) as bigint) * 65536
         + cast(split_part(remote_addr, '.', 3) as bigint) * 256
         + cast(split_part(remote_addr, '.', 4) as bigint) end as v4
  from parsed)"""


def _range(cidr: str) -> tuple[int, int]:
    base, plen = cidr.split("/")
    first = 0
    for octet in base.split("."):
        first = first * 256 + int(octet)
    return first, first + 2 ** (32 - int(plen)) - 1


def _owned() -> str:
    """Owner by range comparison, longest prefix first; the one IPv6 prefix by pattern."""
    v4 = sorted((c for c in CI_PREFIXES if ":" not in c[1]), key=lambda c: -int(c[1].split("/")[1]))
    tests = "".join(
        f" when v4 between {lo} and {hi} then '{name}'" for name, cidr in v4 for lo, hi in [_range(cidr)]
    )
    return f"""
owned as (
  select *, case{tests}
              when regexp_matches(remote_addr, '^2001:db8::[0-9a-f]$') then 'delta'
              else '<unknown>' end as provider
  from addressed)"""


LOOKED_UP = f"with {_ROWS}, {_ADDRESS}, {_owned()}"
DAILY = f"""{LOOKED_UP},
hits as materialized (
  select case when starts_with(request_url, '/package') then 'package' else 'artifact' end as kind,
         case when starts_with(request_url, '/package') then package_uuid else artifact_hash end as key,
         cast(time_utc as date) as day
  from owned
  where provider = '<unknown>' and time_utc is not null
    and (starts_with(request_url, '/package') or starts_with(request_url, '/artifact'))),
edges as (select min(day) as lo, max(day) as hi from hits where kind = 'package'),
days as (select distinct day from hits, edges where kind = 'package' and day > lo and day < hi),
kept as (select hits.* from hits join days using (day))"""
PARSED = f"with {_ROWS}"
LINES = f"with lines as ({lines_sql()})"
REGISTRY = f"""
registry as ({registries_sql()}),
names as (
  select package_uuid, name from registry
  qualify row_number() over (partition by package_uuid order by priority, registry, name) = 1)"""
_MIRROR = f"""with lines as ({lines_sql()}),
mirrored as (
  select cast(try_strptime(regexp_extract(src_file, '(\\d{{8}})', 1), '%Y%m%d') as date) as day,
         replace(line, 'GET /', 'GET /julia/') as line from lines),
per_day as (
  select day, cast(coalesce(sum(case when regexp_matches(line, 'julia/(package|artifact|registry)/')
      then try_cast(nullif(regexp_extract(line, '"GET .*" 200 (\\d+)', 1), '') as bigint) end), 0) as bigint) as bytes
  from mirrored group by day)"""


def _human(value: str) -> str:
    """Scaled number with its unit, one decimal, for values below 1 PB."""
    units = ["B", "KB", "MB", "GB", "TB"]
    cases = []
    for i, unit in enumerate(units):
        size = 1024**i
        scaled = f"({value} / {size}.0::double)"
        test = "else" if i == len(units) - 1 else f"when {scaled} <= 999 then"
        cases.append(f"{test} printf('%.1f {unit}', {scaled})")
    return f"case {' '.join(cases)} end"


def _zero_filled(kind: str, name: str) -> str:
    return f"""{DAILY}
select k.key as {name}, d.day, cast(count(h.day) as bigint) as n
from (select distinct key from kept where kind = '{kind}' and key is not null) k
cross join days d
left join kept h on h.kind = '{kind}' and h.key = k.key and h.day = d.day
group by 1, 2"""


def _wide(kind: str, name: str, labels: list[str]) -> str:
    cells = ", ".join(
        f"cast(count(*) filter (where strftime(day, '%m/%d') = '{d}') as bigint) as \"{d}\"" for d in labels
    )
    return f"""
select key as {name}, count(*) as total_downloads, {cells}
from kept where kind = '{kind}' and key is not null group by 1"""


_FIRST_DAY, _LAST_DAY = date(2024, 1, 1), date(2024, 1, 30)


def _labels(first: date, last: date) -> list[str]:
    return [(first + timedelta(i)).strftime("%m/%d") for i in range((last - first).days + 1)]


def _reject_field() -> str:
    cases, text = "", "^"
    for name, piece in _PIECES:
        text += piece
        cases += f" when not regexp_matches(line, '{text}') then '{name}'"
    return f"case{cases} else 'end_of_line' end"


def _next_token() -> str:
    cases, text = "", "^"
    for name, piece in _PIECES:
        matched = f"regexp_extract(line, '{text}')" if text != "^" else "''"
        cases += f" when reject_field = '{name}' then substr(line, length({matched}) + 1)"
        text += piece
    rest = f"case{cases} else substr(line, length(regexp_extract(line, '{text}')) + 1) end"
    return f"nullif(regexp_extract({rest}, '^\\s*(\\S+)', 1), '')"


def _led_to(name: str, piece: str) -> str:
    """What a line's leading pieces, up to ``piece``, capture under ``name``; '' if they don't match."""
    upto = [n for n, _ in _PIECES].index(piece) + 1
    text = "^" + "".join(p for _, p in _PIECES[:upto])
    names = ", ".join(f"'{n}'" for n in _NAMES[: _NAMES.index(name) + 1])
    return f"regexp_extract(line, '{text}', [{names}]).{name}"


REJECTS = f"""{LINES},
rejects as (
  select src_file, line, {_reject_field()} as reject_field,
         case when u in ('/', '/favicon.ico', '/robots.txt')
                or regexp_matches(u, '^(/meta|/badges/|/detail/|/docs/|/logs/)')
                or lower(agent) = 'statping' then 'known_noise' else 'unknown' end as reject_class
  from (select src_file, line, {_led_to("request_url", "request")} as u, {_led_to("http_user_agent", "http_user_agent")} as agent
        from lines where not regexp_matches(line, '{_FULL}')))"""

_MD5_REGISTERS = f"""{PARSED},
updates as (
  select cast(time_utc as date) as day,
         cast(concat('0x', substr(md5(remote_addr), 3, 1)) as int) * 256
           + cast(concat('0x', substr(md5(remote_addr), 1, 2)) as int) as bucket,
         1 + length(regexp_replace(substr(md5(remote_addr), 20, 4), '[89a-f]', '', 'g')) as rank
  from parsed),
regs as (select day, bucket, cast(max(rank) as int) as rank from updates group by 1, 2)"""


def _estimate(source: str, keys: str) -> str:
    group = f"group by {keys}" if keys else ""
    select = f"{keys}, " if keys else ""
    alpha = 0.7213 / (1 + 1.079 / 4096)
    return f"""
select {select}cast(round(case when raw <= 2.5 * 4096 and zeros > 0 then 4096 * ln(4096.0::double / zeros)
                               else raw end) as bigint) as clients
from (select {select}4096 - count(*) as zeros,
             {alpha!r}::double * 4096 * 4096 / (sum(pow(2.0::double, -rank)) + 4096 - count(*)) as raw
      from {source} {group})"""


# --- masking: the published key of the catalogue, digests by SHA-256 -------------------


def _number(digest: str, start: int, length: int) -> str:
    return f"cast(concat('0x', substr({digest}, {start}, {length})) as bigint)"


def _digest(*parts: str) -> str:
    return f"sha256({' || chr(0) || '.join(parts)})"


def _drawn(kind: str, match: str, random_share: float) -> str:
    """Digest behind the first match of a line: free of the value for a share of the lines."""
    linked = _digest(f"'{MASK_KEY}'", f"'{kind}'", match)
    if not random_share:
        return linked
    free = _digest(f"'{MASK_KEY}'", "''", f"'{kind}'", "sha256(cast(event_id as varchar))", "'1'")
    chance = f"{_number(free, 52, 13)} / {16**13}.0::double"
    return f"case when {chance} < {random_share} then {free} else {linked} end"


def _fake_v6(digest: str) -> str:
    groups = [f"regexp_replace(substr({digest}, {1 + 4 * i}, 4), '^0{{1,3}}', '')" for i in range(8)]
    return " || ':' || ".join(groups)


def _fake_v4(digest: str) -> str:
    return " || '.' || ".join(_number(digest, 1 + 2 * i, 2) for i in range(4))


def _fake_address(v6: str, v4: str) -> str:
    return f"case when addr like '%:%' then {_fake_v6(v6)} else {_fake_v4(v4)} end"


def _fake_time(digest: str, form: str) -> str:
    moment = f"timestamp '2020-09-01' + to_seconds({_number(digest, 1, 13)} % {91 * 24 * 60 * 60})"
    return f"strftime({moment}, '{form}')"


def _masked_lines() -> str:
    """Every line has one address at its start, one time, and at most one 40-digit hash."""
    share = 0.5
    return f"""{LINES},
found as (
  select event_id, line, split_part(line, ' ', 1) as addr, regexp_extract(line, '{_HASH}') as tree,
         regexp_extract(line, '\\d\\d/\\w\\w\\w/\\d\\d\\d\\d:\\d\\d:\\d\\d:\\d\\d') as local,
         regexp_extract(line, '\\d\\d\\d\\d-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d') as iso
  from lines
  where contains(line, '/package') or contains(line, '/artifact') or contains(line, '/registry')),
drawn as (
  select *, {_drawn("ipv6", "addr", share)} as v6, {_drawn("ipv4", "addr", share)} as v4,
         {_drawn("hash", "tree", share)} as h, {_drawn("local_time", "local", share)} as lt,
         {_drawn("iso_time", "iso", share)} as it
  from found),
faked as (
  select *, {_fake_address("v6", "v4")} || substr(line, length(addr) + 1) as l1 from drawn),
hashed as (select *, case when tree = '' then l1 else replace(l1, tree, substr(h, 1, 40)) end as l2 from faked)
select event_id,
       case when local <> '' then replace(l2, local, {_fake_time("lt", "%d/%b/%Y:%H:%M:%S")})
            else replace(l2, iso, {_fake_time("it", "%Y-%m-%dT%H:%M:%S")}) end as line
from hashed"""


def _masked_columns() -> str:
    def tree(name: str) -> str:
        return f"case when {name} is not null then substr({_drawn('hash', name, 0)}, 1, 40) end"

    found = f"regexp_extract(request_url, '{_HASH}')"
    return f"""{PARSED},
drawn as (
  select *, remote_addr as addr, {_drawn("ipv6", "remote_addr", 0)} as v6,
         {_drawn("ipv4", "remote_addr", 0)} as v4, {found} as found from parsed)
select event_id, {_fake_address("v6", "v4")} as remote_addr,
       case when found = '' then request_url
            else replace(request_url, found, substr({_drawn("hash", "found", 0)}, 1, 40)) end as request_url,
       {tree("package_hash")} as package_hash, {tree("artifact_hash")} as artifact_hash, status
from drawn"""


# --- keyed client hash: by the letter, for every address the derived log can hold --------


def register_of(address: bytes, secret: bytes = b"") -> str:
    """Six hex digits of one address: sixteen Feistel rounds, then bucket and rank."""
    half = len(address) // 2
    head, tail = int.from_bytes(address[:half]), address[half:]
    for turn in range(P.HASH_ROUNDS):
        digest = hashlib.sha512(bytes([turn]) + secret + tail).digest()
        for i in range(0, len(digest), half):
            head ^= int.from_bytes(digest[i : i + half])
        if turn < P.HASH_ROUNDS - 1:
            head, tail = int.from_bytes(tail), head.to_bytes(half)
    leading = int.from_bytes((head.to_bytes(half) + tail)[:4])
    bucket, rank = leading & P.BUCKET_MASK, 1
    for bit in range(31, -1, -1):
        if not leading & P.SAMPLE_MASK & 1 << bit:
            break
        rank += 1
    return bytes([bucket & 0xFF, bucket >> 8, rank]).hex()


@functools.cache
def _registers_sql(secret: bytes = b"") -> str:
    """(day, ip, hll_hash): registers cut out of one string, found by the parts of an address.

    IPv4 addresses are 10.(u % 8).(u % 256).(e % 250), IPv6 ones 2001:db8:: and a number below 1000, or
    ::ffff:10.9.8. and one below 100.
    """
    v4 = "".join(register_of(bytes([10, u % 8, u, e]), secret) for u in range(256) for e in range(250))
    v6 = "".join(register_of(ipaddress.ip_address(f"2001:db8::{u}").packed, secret) for u in range(1000))
    tail = "".join(register_of(bytes([*[0] * 10, 255, 255, 10, 9, 8, u]), secret) for u in range(100))
    place = "cast(split_part(remote_addr, '.', 3) as bigint) * 250 + cast(split_part(remote_addr, '.', 4) as bigint)"
    return f"""
with {_ROWS},
tables as (select '{v4}' as v4, '{v6}' as v6, '{tail}' as tail),
hashed as (
  select cast(time_utc as date) as day, remote_addr as ip,
    case when remote_addr like '::ffff:%'
      then substr(tail, 1 + 6 * cast(split_part(remote_addr, '.', 4) as bigint), 6)
      when remote_addr like '2001:db8::%'
      then substr(v6, 1 + 6 * cast(split_part(remote_addr, '::', 2) as bigint), 6)
      else substr(v4, 1 + 6 * ({place}), 6) end as hll_hash
  from parsed cross join tables where remote_addr is not null)"""


def hll_estimates(secret: bytes = b"") -> str:
    part = lambda at: f"cast('0x' || substr(hll_hash, {at}, 2) as bigint)"
    return f"""{_registers_sql(secret)},
regs as (
  select day, {part(1)} + 256 * {part(3)} as bucket, max({part(5)}) as rank from hashed group by 1, 2)
{_estimate("regs", "day")}"""


SPLIT_TOTALS = """
select kind, is_ci, count(event_id) as n
from (values ('package', '/package'), ('artifact', '/artifact')) k(kind, prefix)
cross join (values (true), (false)) f(is_ci)
left join owned on starts_with(request_url, prefix) and (provider <> '<unknown>') = is_ci
group by 1, 2"""


def checking_sql() -> dict[str, str]:
    fields = ", ".join([*_TEXT, "time_utc", "status", "body_bytes_sent", "request_time", "julia_interactive", "pkgserver"])
    no_address = fields.replace("remote_addr, ", "", 1)
    days_01 = _labels(_FIRST_DAY, _LAST_DAY)
    p = PARSED
    return {
        "parse_all_fields": f"{p} select event_id, {fields} from parsed",
        "parse_timestamps": f"{p} select event_id, time_utc from parsed",
        "parse_typed_values": f"{p} select event_id, status, body_bytes_sent, request_time, julia_interactive from parsed",
        "parse_urls": f"{p} select event_id, request_method, request_url, request_http, package_uuid, package_hash, "
        "registry_uuid, registry_hash, artifact_hash from parsed",
        "parse_strict": f"{p} select pkgserver, cache_miss, count(*) as n from parsed group by 1, 2",
        "pkgserver_from_file": f"{LINES} select {_SERVER} as pkgserver, count(*) as n from lines group by 1",
        "reject_classes": f"{REJECTS} select reject_class, reject_field, count(*) as n from rejects group by 1, 2",
        "reject_examples": f"""{REJECTS}
select reject_field, cast(example as int) as example, {_next_token()} as next_token, line from (
  select *, row_number() over (partition by reject_field order by line) as example
  from rejects where reject_class = 'unknown') where example <= 4""",
        "parse_outcomes": f"""{LINES}
select src_file, case when regexp_matches(line, '{_FULL}') then 'row' else 'reject' end as record, count(*) as n
from lines group by 1, 2""",
        "file_selection": f"""{LINES},
files as (
  select distinct src_file, regexp_matches(src_file, '^access_.*\\.pkg\\.julia.*\\.(gz|zst)') as access_log,
         date_diff('second', try_strptime(regexp_extract(src_file, '-(\\d+)\\.gz', 1), '%Y%m%d'),
                   timestamp '2024-02-08 12:00:00') as age
  from lines)
select src_file, access_log, coalesce(age < 15 * 86400, false) as recent_15,
       access_log and coalesce(age < 33 * 86400, false) as selected
from files""",
        "union_files": f"{p} select src_file, count(*) as n from parsed group by 1",
        "freshness_anti_join": f"""{LINES}
select distinct src_file from lines where src_file like 'access\\_kr.%' escape '\\' or src_file like 'access\\_us-east.%' escape '\\'
  or src_file not like 'access\\_%' escape '\\'""",
        "package_requests": f"{p} select event_id, request_url from parsed where starts_with(request_url, '/package')",
        "artifact_requests": f"{p} select event_id, request_url from parsed where starts_with(request_url, '/artifact')",
        "hits_by_package": f"{p} select package_uuid, count(*) as n from parsed where package_uuid is not null group by 1",
        "hits_by_package_with_missing": f"{p} select package_uuid, count(*) as n from parsed "
        "where starts_with(request_url, '/package') group by 1",
        "hits_by_artifact": f"{p} select artifact_hash, count(*) as n from parsed where artifact_hash is not null group by 1",
        "plotted_days": f"{DAILY} select day from days",
        "plotted_day_labels": f"""{DAILY},
labels as (select distinct strftime(day, '%m/%d') as label from hits where kind = 'package')
select label from labels where label > (select min(label) from labels) and label < (select max(label) from labels)""",
        "hits_by_month_day": f"{p} select strftime(time_utc, '%m/%d') as label, count(*) as n from parsed group by 1",
        "package_downloads_by_day": _zero_filled("package", "package_uuid"),
        "artifact_downloads_by_day": _zero_filled("artifact", "artifact_hash"),
        "package_report_wide": f"""{DAILY}, {REGISTRY},
report as ({_wide("package", "package_uuid", days_01)})
select report.*, names.name from report left join names using (package_uuid)""",
        "artifact_report_wide": f"{DAILY} {_wide('artifact', 'artifact_hash', days_01)}",
        "top10_package_series": f"""{DAILY},
top as (select key, count(*) as total from kept where kind = 'package' group by 1
        order by total desc, key asc nulls last limit 10)
select t.key as package_uuid, d.day, cast(count(h.day) as bigint) as n
from top t cross join days d
left join kept h on h.kind = 'package' and h.key is not distinct from t.key and h.day = d.day
group by 1, 2""",
        "group_by_expr": f"""{p}
select case when starts_with(request_url, '/package') then 'package'
            when starts_with(request_url, '/artifact') then 'artifact' else 'other' end as kind,
       status >= 400 as failed, cast(hour(time_utc) as int) as hour, count(*) as n
from parsed group by 1, 2, 3""",
        "row_count": f"{p} select count(*) as n from parsed",
        "distinct_clients": f"{p} select count(distinct remote_addr) as n from parsed",
        "distinct_packages": f"{p} select count(distinct package_uuid) as n from parsed",
        "distinct_values": f"{p} select distinct julia_version as value from parsed where julia_version is not null",
        "present_values": f"{p} select http_user_agent as value, count(*) as n from parsed "
        "where http_user_agent is not null group by 1",
        "package_names": f"""{p}, {REGISTRY}
select p.package_uuid, names.name
from (select distinct package_uuid from parsed where package_uuid is not null) p
left join names using (package_uuid)""",
        "ci_provider": f"{LOOKED_UP} select event_id, provider from owned",
        "ci_provider_shuffled": f"{LOOKED_UP} select event_id, provider from owned",
        "ci_split_totals": LOOKED_UP + SPLIT_TOTALS,
        "non_ci_hits": f"{LOOKED_UP} select event_id from owned where provider = '<unknown>'",
        "ci_hits": f"{LOOKED_UP} select event_id from owned where provider <> '<unknown>'",
        "ci_variables_map": f"""{p}
select event_id, nullif(regexp_extract(julia_ci_variables, '(?:^|;)CI=([^;]*)', 1), '') as ci,
       regexp_matches(julia_ci_variables, '=([^n;]|n[^;])') as is_ci_env
from parsed""",
        "mirror_bytes_by_day": f"{_MIRROR} select day, bytes from per_day",
        "mirror_total": f"""{_MIRROR}, total as (select cast(sum(bytes) as bigint) as bytes from per_day)
select bytes, {_human("bytes")} as human from total""",
        "mirror_line_filter": f"{_MIRROR} select day, count(*) as n from mirrored "
        "where regexp_matches(line, 'julia/(package|artifact|registry)/') group by 1",
        "human_sizes": f"""{LINES},
sums as (
  select user_id, event_type,
         cast(coalesce(sum(try_cast(nullif(regexp_extract(line, '"GET .*" 200 (\\d+)', 1), '') as bigint)), 0)
              * (case event_type when 'click' then 4096 else 1 end) as bigint) as bytes
  from lines group by 1, 2)
select user_id, event_type, bytes, {_human("bytes")} as human from sums""",
        "sanitized": f"{p} select event_id, {no_address} from parsed",
        "anonymize_line_filter": f"""{LINES}
select event_id, line from lines
where contains(line, '/package') or contains(line, '/artifact') or contains(line, '/registry')""",
        "anonymize_lines": _masked_lines(),
        "masked_columns": _masked_columns(),
        "masked_links": f"""{LINES}
select lines, count(*) as n
from (select split_part(line, ' ', 1) as client, count(*) as lines from lines group by 1) group by 1""",
        "hll_hash": f"{_registers_sql()} select distinct ip, hll_hash from hashed",
        "hll_estimate": hll_estimates(),
        "register_table": f"{_MD5_REGISTERS} select day, cast(bucket as int) as bucket, rank from regs",
        "register_estimates": f"{_MD5_REGISTERS} {_estimate('regs', 'day')}",
        "register_merge": f"""{_MD5_REGISTERS},
whole as (select bucket, max(rank) as rank from regs group by 1) {_estimate("whole", "")}""",
        "daily_window_counts": f"{p} select cast(time_utc as date) as day, count(*) as n from parsed where time_utc is not null group by 1",
        "streaming_daily_counts": f"{p} select cast(time_utc as date) as day, count(*) as n from parsed where time_utc is not null group by 1",
    }
