"""An access log derived from the ``events`` table, for the query catalogue.

The given tables hold no access logs, so one line is written per event. The SQL text is the
same for Spark and for the checking engine except for three hooks: timestamp formatting,
text casts and integer-to-text date patterns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Lines no resource is asked for come in fourteen forms: one well-formed, the others each with one
# piece broken; their URLs and agents are every kind of known noise and some that are not. Among the
# rest are times, numbers and file names that look right but stand for nothing.
_LINES = """
select event_id, user_id, event_type, ts,
  case when event_id % 53 = 1 then 'access_kr.pkg.julialang.org.log'
       when event_id % 59 = 2 then concat('error_kr.pkg.julialang.org.log-', {file_day}, '.gz')
       when event_id % 61 = 3 then 'access_kr.pkg.julialang.org.log-20241350.gz'
       else concat('access_', case event_id % 4 when 0 then 'us-east' when 1 then 'eu-central'
                                      when 2 then 'cn-east' else 'kr' end,
         '.pkg.julialang.org.log-', {file_day}, '.gz') end as src_file,
  concat(
    case when broken = 1 then 'gateway!'
         when event_id % 10 = 9 and user_id % 5 = 0 then concat('::ffff:10.9.8.', user_id % 100)
         when event_id % 10 = 9 then concat('2001:db8::', user_id % 1000)
         else concat('10.', user_id % 8, '.', user_id % 256, '.', event_id % 250) end,
    ' [', case when broken = 2 then 'no time'
       when event_id % 19 = 3 then '31/Feb/2024:10:00:00 +0000]'
       when event_id % 23 = 5 then concat({iso_time}, '+19:45]')
       when event_id % 47 = 8 then '2024-01-05T25:00:61+00:00]'
       when event_id % 3 = 0 then concat({local_time}, ' +0000]')
       when event_id % 3 = 1 then concat({local_time}, ' +0230]')
       else concat({iso_time}, '-02:30]') end,
    ' "', case when event_id % 41 = 4 then 'HEAD ' else 'GET ' end, case event_type
       when 'view' then concat('/package/', substr({user_md5},1,8), '-', substr({user_md5},9,4),
            '-', substr({user_md5},13,4), '-', substr({user_md5},17,4),
            '-', substr({user_md5},21,12), '/', md5({event_mod_7}), 'deadbeef')
       when 'purchase' then concat('/package/', substr(md5({user_mod_20}),1,8),
            '-0000-0000-0000-000000000000/', {user_md5}, 'deadbeef')
       when 'click'  then concat('/artifact/', md5({user_mod_40}), 'cafebabe')
       when 'signup' then concat('/registry/23338594-aafe-5451-b93e-139f81909106/',
            md5({event_mod_30}), '0badf00d')
       else case when broken is null then concat('/package/not-a-uuid/', event_id)
            else case user_id % 12 when 0 then '/' when 1 then '/favicon.ico' when 2 then '/robots.txt'
                 when 3 then '/badges/a.svg' when 4 then '/detail/a' when 5 then '/docs/a' when 6 then '/logs/a'
                 when 7 then '/meta/siblings' else concat('/other/', user_id) end end end,
    case when broken = 3 then '"' else ' HTTP/1.1"' end, ' ',
    case when broken = 4 then 'ok' when event_id % 29 = 7 then '99999999999999999999'
         when event_type = 'error' or event_id % 43 = 6 then '404' else '200' end,
    ' ', case when broken = 5 then '12k' when event_id % 31 = 3 then '88888888888888888888'
         else cast(cast(floor(value * 100) as bigint) as {text_type}) end,
    case when broken = 6 then ' agent ' when event_id % 11 = 0 then ' "-" '
         when user_id % 12 = 9 and broken is not null then ' "StatPing" '
         else ' "libcurl/7.71.1 julia/1.6.0" ' end,
    case when broken = 7 then 'n/a' when event_id % 37 = 2 then '1.2.3'
         else concat(event_id % 5, '.', event_id % 1000) end,
    ' ', case when broken = 8 then 'dev' when event_id % 13 = 0 then '-' else concat('1.', user_id % 10, '.0') end,
    case when broken = 9 then '  ' else ' x86_64-linux-gnu ' end,
    case when broken = 10 then '"C I"' when user_id % 4 = 0 then '"CI=t;GITHUB_ACTIONS=t"'
         else '"CI=n;GITHUB_ACTIONS=n"' end,
    case when broken = 11 then '  ' else concat(' ',
      case event_id % 4 when 0 then 'true' when 1 then 'false' when 2 then '1' else '-' end, ' ') end,
    case when broken = 12 then '"a b"' else '"-"' end, ' ',
    case when event_id % 17 = 0 then '"bad' else concat('"r', event_id, '"') end,
    ' "', case when broken = 13 then 'hit' when event_id % 6 = 0 then 'miss' else '-' end, '"') as line
from (
  select *, case when event_type not in ('view', 'purchase', 'click', 'signup') and event_id % 2 = 0
                 then cast(floor(event_id / 2) as bigint) % 14 end as broken
  from {events}) as marked
"""

# Both registries know every user's package, with priorities that let either come first or
# tie; the packages of purchases are in neither.
_REGISTRIES = """
select {uuid} as package_uuid, concat('pkg-', user_id) as name, 'General' as registry,
       cast(1 + user_id % 3 as int) as priority
from (select distinct user_id from {events})
union all
select {uuid}, concat('private-', user_id), 'Private', 2
from (select distinct user_id from {events})
"""

_SPARK = {
    "file_day": "date_format(ts, 'yyyyMMdd')",
    "local_time": "date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')",
    "iso_time": r"date_format(ts, 'yyyy-MM-dd\'T\'HH:mm:ss')",
}
_DUCKDB = {
    "file_day": "strftime(ts, '%Y%m%d')",
    "local_time": "strftime(ts, '%d/%b/%Y:%H:%M:%S')",
    "iso_time": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
}


def _md5_hooks(text_type: str) -> dict[str, str]:
    def text(x: str) -> str:
        return f"cast({x} as {text_type})"

    user = f"md5({text('user_id')})"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return {
        "user_md5": user,
        "text_type": text_type,
        "event_mod_7": text("event_id % 7"),
        "event_mod_30": text("event_id % 30"),
        "user_mod_20": text("user_id % 20"),
        "user_mod_40": text("user_id % 40"),
        "uuid": "concat(" + ", '-', ".join(f"substr({user},{a},{n})" for a, n in cuts) + ")",
    }


def lines_sql(events: str = "events") -> str:
    """The log lines, for the checking engine."""
    return _LINES.format(events=events, **_DUCKDB, **_md5_hooks("varchar"))


def registries_sql(events: str = "events") -> str:
    return _REGISTRIES.format(events=events, **_md5_hooks("varchar"))


MASK_KEY = "catalogue"
CI_PREFIXES = [
    ("alpha", "10.0.0.0/16"),
    ("beta", "10.4.0.0/14"),
    ("gamma", "10.4.12.0/24"),
    ("delta", "2001:db8::/124"),
]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread_small(df: DataFrame) -> DataFrame:
    """Spreads a scan that has fewer splits than the cluster has cores.

    That is the case of one small file; a large table has more splits and passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def lines_of_events(events: DataFrame) -> DataFrame:
    """(event_id, user_id, event_type, ts, src_file, line)."""
    sql = _LINES.format(events="{events}", **_SPARK, **_md5_hooks("string"))
    return events.sparkSession.sql(sql, events=events)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of_events(spread_small(_events(spark, sf_dir)))


def registry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = _REGISTRIES.format(events="{events}", **_md5_hooks("string"))
    return spark.sql(sql, events=_events(spark, sf_dir))


def prefix_rows(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{provider}', '{cidr}')" for provider, cidr in CI_PREFIXES)
    return spark.sql(f"select * from values {rows} as t(provider, cidr)")
