"""Checking SQL of the queries that go through files: what the files hold is known from their lines."""

from __future__ import annotations

from hitledger.plans import checks as C
from hitledger.plans.file_queries import SECRET, TODAY
from hitledger.plans.sample_log import lines_sql

_RECENT = (
    r"regexp_matches(src_file, '^access_.*\.pkg\.julia.*\.(gz|zst)') and coalesce(date_diff('second', "
    r"try_strptime(regexp_extract(src_file, '-(\d+)\.gz', 1), '%Y%m%d'), timestamp '2024-02-08 12:00:00') < 33 * 86400, false)"
)
_DAY = r"try_cast(regexp_extract(src_file, '(\d\d)\.gz$', 1) as int)"


def of_files(sql: str, chosen: str) -> str:
    """The same question about the lines of some files."""
    every = f"lines as ({lines_sql()})"
    return sql.replace(every, f"every as ({lines_sql()}), lines as (select * from every where {chosen})")


def file_checking_sql() -> dict[str, str]:
    parsed, lines = of_files(C.PARSED, _RECENT), of_files(C.LINES, _RECENT)
    daily, looked_up = of_files(C.DAILY, _RECENT), of_files(C.LOOKED_UP, _RECENT)
    today = f"src_file = '{TODAY}'"
    explicit = of_files(C.PARSED, r"regexp_matches(src_file, '^access_cn-east.*[02468]\.gz$')")
    by_file = "select src_file, count(*) as n from parsed group by 1"
    return {
        "files_scanned": f"{lines} select src_file, count(*) as n from lines group by 1",
        "files_parsed": f"{parsed} select src_file, status, count(*) as n from parsed group by 1, 2",
        "files_rejected": f"""{of_files(C.REJECTS, _RECENT)}
select src_file, reject_field, reject_class, count(*) as n from rejects group by 1, 2, 3""",
        "files_unreadable": f"""{lines}
select distinct replace(src_file, 'access_kr', 'access_broken') as src_file
from lines where src_file like 'access\\_kr.%' escape '\\' and {_DAY} % 9 = 4""",
        "files_clients": of_files(C.hll_estimates(SECRET), _RECENT),
        "files_totals": looked_up + C.SPLIT_TOTALS,
        "files_package_csv": f"""{daily}, {C.REGISTRY}
select key as uuid, any_value(names.name) as name, count(*) as total_downloads
from kept left join names on names.package_uuid = key where kind = 'package' and key is not null group by 1""",
        "files_artifact_csv": f"""{daily}
select key as hash, count(*) as total_downloads from kept where kind = 'artifact' and key is not null group by 1""",
        "files_sanitized": f"""{parsed}
select pkgserver, cast(time_utc as date) as day, julia_interactive, count(*) as n from parsed group by 1, 2, 3""",
        "files_anonymized": f"""{of_files(C.LINES, today)}
select regexp_extract(line, '[^ ]*$') as cache_miss, count(*) as n from lines
where contains(line, '/package') or contains(line, '/artifact') or contains(line, '/registry') group by 1""",
        "files_quick_look": f"""{of_files(C.PARSED, today)}
select count(*) as rows, count(distinct remote_addr) as clients, count(distinct package_uuid) as packages from parsed""",
        "files_explicit": f"{explicit} {by_file}",
        "files_healed": f"{explicit} {by_file}",
        "files_refreshed": of_files(
            C.PARSED,
            f"""event_id in (
  select event_id from (
    select event_id, event_id % 8 = 1 as kept, {_DAY} % 2 = 0 as even, bool_or(event_id % 8 = 1) over (partition by src_file) as again
    from every where src_file like 'access\\_eu-central.%' escape '\\')
  where kept or not even or not again)""",
        )
        + by_file,
        "files_transformed": f"""{of_files(C.PARSED, _RECENT + r" and src_file like 'access\_us-east.%' escape '\'")}
select status + 1000 as status, count(*) as n from parsed group by 1""",
        "files_mirror": f"""with lines as ({lines_sql()}),
mirrored as (select cast(ts as date) as day, replace(line, 'GET /', 'GET /julia/') as line from lines)
select day, cast(coalesce(sum(case when regexp_matches(line, 'julia/(package|artifact|registry)/')
    then try_cast(nullif(regexp_extract(line, '"GET .*" 200 (\\d+)', 1), '') as bigint) end), 0) as bigint) as bytes
from mirrored where day between date '2024-01-09' and date '2024-02-07' group by 1""",
    }
