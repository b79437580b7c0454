"""Every catalogue query on the log derived from ``events``: name -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.iphash import hll_hash
from hitledger.functions.values import month_day, server_of
from hitledger.operators import counts, enrich, mirror, parse, privacy, registers
from hitledger.plans import sample_log
from hitledger.plans.file_queries import FILE_QUERIES
from hitledger.stages import shared
from hitledger.sources.listing import default_selection, is_access_log, is_recent
from hitledger.sources.textscan import mirror_day
from hitledger.streaming.ingest import daily_counts, run_to_folder

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = datetime(2024, 2, 8, 12, 0, 0)


def parsed(spark: SparkSession, sf_dir: str, *only: str) -> DataFrame:
    """All fields and the server, or just some fields."""
    lines = sample_log.log_lines(spark, sf_dir)
    if only:
        return parse.parse_lines(lines, "line", ["event_id"], only=only)
    return parse.parse_lines(lines, "line", ["event_id"], F.col("src_file"))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(
        spark, sf_dir, "remote_addr", "time_utc", "request_url", "package_uuid", "artifact_hash"
    )


def prefixes(spark: SparkSession) -> enrich.PrefixTable:
    return enrich.PrefixTable.build(sample_log.prefix_rows(spark))


def daily(spark: SparkSession, sf_dir: str) -> counts.DailyHits:
    rows = enrich.non_ci_rows(report_rows(spark, sf_dir), prefixes(spark))
    return counts.DailyHits.of(shared(counts.daily_hits(rows)))


# --- parsing --------------------------------------------------------------------------


def parse_all_fields(spark, sf_dir):
    return parsed(spark, sf_dir)


def parse_timestamps(spark, sf_dir):
    return parsed(spark, sf_dir, "time_utc")


def parse_typed_values(spark, sf_dir):
    return parsed(
        spark, sf_dir, "status", "body_bytes_sent", "request_time", "julia_interactive"
    )


def parse_urls(spark, sf_dir):
    return parsed(
        spark,
        sf_dir,
        "request_method",
        "request_url",
        "request_http",
        "package_uuid",
        "package_hash",
        "registry_uuid",
        "registry_hash",
        "artifact_hash",
    )


def parse_strict(spark, sf_dir):
    """Rows per server under the layout whose last two fields are mandatory."""
    lines = sample_log.log_lines(spark, sf_dir)
    strict = parse.ACCESS_LOG.with_strict_tail()
    rows = parse.parse_lines(lines, "line", [], F.col("src_file"), strict)
    return counts.count_by(rows, pkgserver=F.col("pkgserver"), cache_miss=F.col("cache_miss"))


def pkgserver_from_file(spark, sf_dir):
    lines = sample_log.log_lines(spark, sf_dir)
    return counts.count_by(lines, pkgserver=server_of(F.col("src_file")))


def reject_classes(spark, sf_dir):
    rejects = parse.rejected_lines(sample_log.log_lines(spark, sf_dir), "line")
    return counts.count_by(
        rejects, reject_class=F.col("reject_class"), reject_field=F.col("reject_field")
    )


def reject_examples(spark, sf_dir):
    rejects = parse.rejected_lines(sample_log.log_lines(spark, sf_dir), "line")
    return parse.reject_examples(rejects).select(
        "reject_field", "example", "next_token", "line"
    )


def parse_outcomes(spark, sf_dir):
    """Parsed and rejected lines per file, from the one-pass ingest projection."""
    lines = sample_log.log_lines(spark, sf_dir)
    every = parse.parse_or_reject(lines, "line", ["src_file"], F.col("src_file"))
    return counts.count_by(every, src_file=F.col("src_file"), record=F.col("record"))


# --- files ----------------------------------------------------------------------------


def _files(spark, sf_dir):
    return sample_log.log_lines(spark, sf_dir).groupBy("src_file").agg(
        F.max("event_id").alias("src_mtime")
    )


def file_selection(spark, sf_dir):
    name = F.col("src_file")
    return _files(spark, sf_dir).select(
        "src_file",
        is_access_log(name).alias("access_log"),
        is_recent(name, 15, AS_OF).alias("recent_15"),
        default_selection(name, AS_OF).alias("selected"),
    )


def union_files(spark, sf_dir):
    lines = sample_log.log_lines(spark, sf_dir)
    rows = parse.parse_lines(lines, "line", ["src_file"], only=["status"])
    return counts.count_by(rows, src_file=F.col("src_file"))


def freshness_anti_join(spark, sf_dir):
    """Files a manifest does not hold at their current modification time."""
    files = _files(spark, sf_dir)
    server = server_of(F.col("src_file"))
    manifest = files.where(server != "kr").withColumn(
        "src_mtime", F.when(server == "us-east", F.col("src_mtime") - 1).otherwise(F.col("src_mtime"))
    )
    return files.join(manifest, ["src_file", "src_mtime"], "left_anti").select("src_file")


# --- requests and counts --------------------------------------------------------------


def package_requests(spark, sf_dir):
    rows = parsed(spark, sf_dir, "request_url").where(counts.is_package_request())
    return rows.select("event_id", "request_url")


def artifact_requests(spark, sf_dir):
    rows = parsed(spark, sf_dir, "request_url").where(counts.is_artifact_request())
    return rows.select("event_id", "request_url")


def hits_by_package(spark, sf_dir):
    hits = counts.hits_by_package(parsed(spark, sf_dir, "request_url", "package_uuid")).where(F.col("package_uuid").isNotNull())
    return counts.ranked(hits, "package_uuid")


def hits_by_artifact(spark, sf_dir):
    hits = counts.hits_by_artifact(parsed(spark, sf_dir, "request_url", "artifact_hash")).where(F.col("artifact_hash").isNotNull())
    return counts.ranked(hits, "artifact_hash")


def hits_by_package_with_missing(spark, sf_dir):
    """Malformed package paths form a group of their own."""
    return counts.hits_by_package(parsed(spark, sf_dir, "request_url", "package_uuid"))


def plotted_days(spark, sf_dir):
    rows = enrich.non_ci_rows(report_rows(spark, sf_dir), prefixes(spark))
    return counts.plotted_days(shared(counts.daily_hits(rows)))


def plotted_day_labels(spark, sf_dir):
    rows = enrich.non_ci_rows(report_rows(spark, sf_dir), prefixes(spark))
    return counts.plotted_day_labels(shared(counts.daily_hits(rows)))


def hits_by_month_day(spark, sf_dir):
    return counts.count_by(parsed(spark, sf_dir, "time_utc"), label=month_day(F.col("time_utc")))


def package_downloads_by_day(spark, sf_dir):
    return daily(spark, sf_dir).by_day(counts.PACKAGE, "package_uuid")


def artifact_downloads_by_day(spark, sf_dir):
    return daily(spark, sf_dir).by_day(counts.ARTIFACT, "artifact_hash")


def package_report_wide(spark, sf_dir):
    report = daily(spark, sf_dir).wide(counts.PACKAGE, "package_uuid")
    named = enrich.with_package_name(report, sample_log.registry_names(spark, sf_dir))
    return counts.ranked(named, "package_uuid", "total_downloads")


def artifact_report_wide(spark, sf_dir):
    report = daily(spark, sf_dir).wide(counts.ARTIFACT, "artifact_hash")
    return counts.ranked(report, "artifact_hash", "total_downloads")


def top10_package_series(spark, sf_dir):
    return daily(spark, sf_dir).top_series().withColumnRenamed("key", "package_uuid")


def group_by_expr(spark, sf_dir):
    rows = parsed(spark, sf_dir, "request_url", "status", "time_utc")
    return counts.count_by(
        rows,
        kind=F.coalesce(counts.request_kind(), F.lit("other")),
        failed=F.col("status") >= 400,
        hour=F.hour("time_utc"),
    )


def row_count(spark, sf_dir):
    return parsed(spark, sf_dir, "remote_addr").agg(F.count(F.lit(1)).alias("n"))


def distinct_clients(spark, sf_dir):
    return counts.count_distinct_of(parsed(spark, sf_dir, "remote_addr"), "remote_addr")


def distinct_packages(spark, sf_dir):
    return counts.count_distinct_of(parsed(spark, sf_dir, "package_uuid"), "package_uuid")


def distinct_values(spark, sf_dir):
    return (
        counts.present_values(parsed(spark, sf_dir, "julia_version"), "julia_version")
        .distinct()
        .withColumnRenamed("julia_version", "value")
    )


def present_values(spark, sf_dir):
    """Every non-missing user agent, with how often it occurs."""
    agents = counts.present_values(parsed(spark, sf_dir, "http_user_agent"), "http_user_agent")
    return counts.count_by(agents, value=F.col("http_user_agent"))


# --- lookups --------------------------------------------------------------------------


def package_names(spark, sf_dir):
    seen = counts.hits_by_package(parsed(spark, sf_dir, "request_url", "package_uuid")).where(F.col("package_uuid").isNotNull())
    named = enrich.with_package_name(seen, sample_log.registry_names(spark, sf_dir))
    return named.select("package_uuid", "name")


def ci_provider(spark, sf_dir):
    rows = parsed(spark, sf_dir, "remote_addr")
    return enrich.with_provider(rows, prefixes(spark)).select("event_id", "provider")


def ci_provider_shuffled(spark, sf_dir):
    """The same lookup the way a prefix table too large to broadcast takes."""
    rows = parsed(spark, sf_dir, "remote_addr")
    large = enrich.PrefixTable.build(sample_log.prefix_rows(spark), most_rows=0)
    return enrich.with_provider(rows, large).select("event_id", "provider")


def ci_split_totals(spark, sf_dir):
    rows = enrich.with_ci_flag(parsed(spark, sf_dir, "remote_addr", "request_url"), prefixes(spark))
    return counts.split_totals(counts.single_requests(rows))


def non_ci_hits(spark, sf_dir):
    return enrich.non_ci_rows(parsed(spark, sf_dir, "remote_addr"), prefixes(spark)).select("event_id")


def ci_hits(spark, sf_dir):
    return enrich.ci_rows(parsed(spark, sf_dir, "remote_addr"), prefixes(spark)).select("event_id")


def ci_variables_map(spark, sf_dir):
    variables = F.col("julia_ci_variables")
    return parsed(spark, sf_dir, "julia_ci_variables").select(
        "event_id",
        F.try_element_at(enrich.ci_variables(variables), F.lit("CI")).alias("ci"),
        enrich.is_ci_environment(variables).alias("is_ci_env"),
    )


# --- mirror ---------------------------------------------------------------------------


def _mirror_lines(spark, sf_dir):
    lines = sample_log.log_lines(spark, sf_dir)
    return lines.select(
        mirror_day(F.col("src_file")).alias("day"),
        F.replace("line", F.lit("GET /"), F.lit("GET /julia/")).alias("line"),
    )


def mirror_bytes_by_day(spark, sf_dir):
    per_day = mirror.bytes_by_day(_mirror_lines(spark, sf_dir))
    return per_day.select("day", F.col("bytes").cast("bigint").alias("bytes"))


def mirror_total(spark, sf_dir):
    total = mirror.total_bytes(mirror.bytes_by_day(_mirror_lines(spark, sf_dir)))
    return total.select(F.col("bytes").cast("bigint").alias("bytes"), "human")


def mirror_line_filter(spark, sf_dir):
    return counts.count_by(mirror.mirror_lines(_mirror_lines(spark, sf_dir)), day=F.col("day"))


def human_sizes(spark, sf_dir):
    """Readable totals per user and status, over several orders of magnitude."""
    rows = sample_log.log_lines(spark, sf_dir).select("user_id", "event_type", "line")
    served = rows.select("user_id", "event_type", mirror.served_bytes().alias("served"))
    sums = served.groupBy("user_id", "event_type").agg(F.coalesce(F.sum("served"), F.lit(0)).alias("bytes"))
    scaled = sums.withColumn("bytes", F.col("bytes") * F.when(F.col("event_type") == "click", 4096).otherwise(1))
    return scaled.select("user_id", "event_type", "bytes", mirror.human_bytes(F.col("bytes")).alias("human"))


# --- privacy --------------------------------------------------------------------------


def sanitized(spark, sf_dir):
    return privacy.without_address(parsed(spark, sf_dir))


def anonymize_line_filter(spark, sf_dir):
    lines = sample_log.log_lines(spark, sf_dir).select("event_id", "line")
    return privacy.resource_lines(lines, "line")


def anonymize_lines(spark, sf_dir):
    lines = sample_log.log_lines(spark, sf_dir).select("event_id", "line")
    chosen = privacy.resource_lines(lines, "line")
    return privacy.mask_lines(chosen, sample_log.MASK_KEY, "line", ["event_id"])


def masked_links(spark, sf_dir):
    """Fully keyed masking keeps who-is-who: lines per pseudonym, without the pseudonym."""
    lines = sample_log.log_lines(spark, sf_dir).select("line")
    masked = privacy.mask_lines(lines, sample_log.MASK_KEY, "line", random_share=0.0)
    client = F.substring_index("line", " ", 1)
    per_client = counts.count_by(masked, client=client)
    return counts.count_by(per_client.select(F.col("n").alias("lines")), lines=F.col("lines"))


def masked_columns(spark, sf_dir):
    return privacy.mask_columns(parsed(spark, sf_dir), sample_log.MASK_KEY).select(
        "event_id", "remote_addr", "request_url", "package_hash", "artifact_hash", "status"
    )


# --- client hashes --------------------------------------------------------------------


def hashed_clients(spark, sf_dir):
    rows = parsed(spark, sf_dir, "remote_addr").select(F.col("remote_addr").alias("ip"))
    # hashed where the rows are parsed, as the ingest job does it
    return rows.withColumn("hll_hash", hll_hash(F.col("ip"))).distinct()


def hll_estimate(spark, sf_dir):
    rows = parsed(spark, sf_dir, "remote_addr", "time_utc").select(
        F.to_date("time_utc").alias("day"), "remote_addr"
    )
    hashed = rows.withColumn("hll_hash", hll_hash(F.col("remote_addr")))
    per_day = registers.estimate_clients(hashed, ["day"])
    return per_day.select("day", F.round("clients").cast("bigint").alias("clients"))


def _md5_registers(spark, sf_dir):
    """Register updates drawn from md5 instead of the keyed hash, so SQL can repeat them."""
    digest = F.md5(F.col("remote_addr"))
    rank = F.lit(1) + sum(
        (F.when(F.substring(digest, 20 + i, 1) < "8", 1).otherwise(0) for i in range(4)), F.lit(0)
    )
    bucket = F.concat(F.substring(digest, 1, 2), F.lit("0"), F.substring(digest, 3, 1))
    return parsed(spark, sf_dir, "remote_addr", "time_utc").select(
        F.to_date("time_utc").alias("day"),
        F.concat(bucket, F.lpad(F.hex(rank), 2, "0")).alias("hll_hash"),
    )


def register_table(spark, sf_dir):
    return registers.registers(_md5_registers(spark, sf_dir), ["day"])


def register_estimates(spark, sf_dir):
    per_day = registers.estimate_clients(_md5_registers(spark, sf_dir), ["day"])
    return per_day.select("day", F.round("clients").cast("bigint").alias("clients"))


def register_merge(spark, sf_dir):
    """The whole window's estimate from its days' registers."""
    per_day = registers.registers(_md5_registers(spark, sf_dir), ["day"])
    total = registers.estimated(registers.merged(per_day, []), [])
    return total.select(F.round("clients").cast("bigint").alias("clients"))


# --- windows over time ----------------------------------------------------------------


def daily_window_counts(spark, sf_dir):
    return daily_counts(parsed(spark, sf_dir, "time_utc"))


def streaming_daily_counts(spark, sf_dir):
    """The same counts by a stream that reads the events, parses and closes its windows."""
    folder = f"{sf_dir}/events*.parquet"
    schema = spark.read.parquet(folder).schema
    events = spark.readStream.schema(schema).parquet(folder)
    lines = sample_log.lines_of_events(events)
    rows = parse.parse_lines(lines, "line", ["event_id"], only=["time_utc"])
    return run_to_folder(daily_counts(rows), "update", keys=["day"])


CATALOGUE: dict[str, Query] = {
    "parse_all_fields": parse_all_fields,
    "parse_timestamps": parse_timestamps,
    "parse_typed_values": parse_typed_values,
    "parse_urls": parse_urls,
    "parse_strict": parse_strict,
    "pkgserver_from_file": pkgserver_from_file,
    "reject_classes": reject_classes,
    "reject_examples": reject_examples,
    "parse_outcomes": parse_outcomes,
    "file_selection": file_selection,
    "union_files": union_files,
    "freshness_anti_join": freshness_anti_join,
    "package_requests": package_requests,
    "artifact_requests": artifact_requests,
    "hits_by_package": hits_by_package,
    "hits_by_package_with_missing": hits_by_package_with_missing,
    "hits_by_artifact": hits_by_artifact,
    "plotted_days": plotted_days,
    "plotted_day_labels": plotted_day_labels,
    "hits_by_month_day": hits_by_month_day,
    "package_downloads_by_day": package_downloads_by_day,
    "artifact_downloads_by_day": artifact_downloads_by_day,
    "package_report_wide": package_report_wide,
    "artifact_report_wide": artifact_report_wide,
    "top10_package_series": top10_package_series,
    "group_by_expr": group_by_expr,
    "row_count": row_count,
    "distinct_clients": distinct_clients,
    "distinct_packages": distinct_packages,
    "distinct_values": distinct_values,
    "present_values": present_values,
    "package_names": package_names,
    "ci_provider": ci_provider,
    "ci_provider_shuffled": ci_provider_shuffled,
    "ci_split_totals": ci_split_totals,
    "non_ci_hits": non_ci_hits,
    "ci_hits": ci_hits,
    "ci_variables_map": ci_variables_map,
    "mirror_bytes_by_day": mirror_bytes_by_day,
    "mirror_total": mirror_total,
    "mirror_line_filter": mirror_line_filter,
    "human_sizes": human_sizes,
    "sanitized": sanitized,
    "anonymize_line_filter": anonymize_line_filter,
    "anonymize_lines": anonymize_lines,
    "masked_links": masked_links,
    "masked_columns": masked_columns,
    "hll_hash": hashed_clients,
    "hll_estimate": hll_estimate,
    "register_table": register_table,
    "register_estimates": register_estimates,
    "register_merge": register_merge,
    "daily_window_counts": daily_window_counts,
    "streaming_daily_counts": streaming_daily_counts,
    **FILE_QUERIES,
}
