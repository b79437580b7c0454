"""Catalogue queries that go through files: the derived log is written as a server would leave it,
then read, parsed, stored, healed, refreshed and exported by the real jobs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.operators import counts
from hitledger.plans import exports, jobs, refresh, sample_log
from hitledger.plans.sample_files import BROKEN, log_folder, made_once, mirror_folder, write_files
from hitledger.sources.dimensions import ci_prefixes, legacy_csv, registries
from hitledger.sources.listing import default_selection, list_files
from hitledger.sources.ranges import open_uri
from hitledger.sources.textscan import scan_directory
from hitledger.stages import new_folder

AS_OF = datetime(2024, 2, 8, 12, 0, 0)
SECRET = b"catalogue"
#: The log of today: its name holds no day, and nothing compresses it.
TODAY = "access_kr.pkg.julialang.org.log"


def _name() -> Column:
    return F.col("src_file")


def _whole_files() -> Column:
    """A user's predicate: recent access logs of all servers but one."""
    return default_selection(_name(), AS_OF) & ~_name().startswith(BROKEN)


def _key_file(spark: SparkSession, sf_dir: str) -> str:
    def make(path: str) -> None:
        store, name = open_uri(f"{path}/key")
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(name) as out:
            out.write(SECRET)

    return made_once(spark, sf_dir, "key", make) + "/key"


def _store(spark: SparkSession, sf_dir: str) -> str:
    """The recent access logs, broken ones among them, in a store."""
    logs, key = log_folder(spark, sf_dir), _key_file(spark, sf_dir)
    return made_once(spark, sf_dir, "store", lambda path: jobs.parse_directory(spark, logs, path, AS_OF, key))


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """CI prefixes and registries, read from CSV files."""

    def make(path: str) -> None:
        sample_log.prefix_rows(spark).write.option("header", True).csv(f"{path}/prefixes.csv")
        sample_log.registry_names(spark, sf_dir).write.option("header", True).csv(f"{path}/registries.csv")

    folder = made_once(spark, sf_dir, "dimensions", make)
    return ci_prefixes(spark, f"{folder}/prefixes.csv"), registries(spark, f"{folder}/registries.csv")


def files_scanned(spark, sf_dir):
    """Lines per file of the files a user's predicate chooses."""
    lines = scan_directory(spark, log_folder(spark, sf_dir), AS_OF, _whole_files())
    return counts.count_by(lines, src_file=_name())


def files_parsed(spark, sf_dir):
    rows = refresh.read_rows(spark, _store(spark, sf_dir), secret=SECRET)
    return counts.count_by(rows, src_file=_name(), status=F.col("status"))


def files_rejected(spark, sf_dir):
    rejects = refresh.read_rejects(spark, _store(spark, sf_dir), secret=SECRET)
    return counts.count_by(rejects, src_file=_name(), reject_field=F.col("reject_field"), reject_class=F.col("reject_class"))


def files_unreadable(spark, sf_dir):
    found = refresh.unreadable_files(spark, _store(spark, sf_dir))
    return found.select(F.substring_index("src_path", "/", -1).alias("src_file"))


def files_clients(spark, sf_dir):
    """Distinct clients a day, from the registers that the store keeps by run."""
    prefixes, _ = _dimensions(spark, sf_dir)
    found = jobs.stored_clients(spark, _store(spark, sf_dir), prefixes, _key_file(spark, sf_dir))
    return found.select("day", F.round("clients").cast("bigint").alias("clients"))


def _reports(spark: SparkSession, sf_dir: str) -> jobs.Reports:
    store, key = _store(spark, sf_dir), _key_file(spark, sf_dir)
    return jobs.stored_reports(spark, store, *_dimensions(spark, sf_dir), new_folder(spark, "reports"), AS_OF, key)


def files_totals(spark, sf_dir):
    return _reports(spark, sf_dir).totals


def files_package_csv(spark, sf_dir):
    """The published report, read back."""
    report = spark.read.option("header", True).csv(_reports(spark, sf_dir).package_csv)
    return report.select("uuid", "name", F.col("total_downloads").cast("bigint").alias("total_downloads"))


def files_artifact_csv(spark, sf_dir):
    report = spark.read.option("header", True).csv(_reports(spark, sf_dir).artifact_csv)
    return report.select("hash", F.col("total_downloads").cast("bigint").alias("total_downloads"))


def files_sanitized(spark, sf_dir):
    """The address-free export as CSV, read back with the schema of old exports."""
    output = new_folder(spark, "clean")
    exports.write_sanitized(refresh.read_rows(spark, _store(spark, sf_dir), secret=SECRET), output, "csv")
    rows = legacy_csv(spark, output, without=("remote_addr",))
    return counts.count_by(
        rows, pkgserver=F.col("pkgserver"), day=F.to_date("time_utc"), julia_interactive=F.col("julia_interactive")
    )


def files_anonymized(spark, sf_dir):
    """Lines of the masked log by their last field."""
    output = new_folder(spark, "masked")
    jobs.anonymize_file(spark, f"{log_folder(spark, sf_dir)}/{TODAY}", output, sample_log.MASK_KEY, "seed")
    return counts.count_by(spark.read.text(output), cache_miss=F.substring_index("value", " ", -1))


def files_quick_look(spark, sf_dir):
    return jobs.quick_look(spark, f"{log_folder(spark, sf_dir)}/{TODAY}")


def _explicit(spark: SparkSession, sf_dir: str) -> str:
    """A store of files that a user lists by name: those of one server with an even day."""
    listed = list_files(spark, log_folder(spark, sf_dir)).where(_name().rlike(r"^access_cn-east.*[02468]\.gz$"))

    def make(path: str) -> None:
        jobs.parse_files(spark, [r.src_path for r in listed.collect()], path)

    return made_once(spark, sf_dir, "explicit", make)


def files_explicit(spark, sf_dir):
    return counts.count_by(refresh.read_rows(spark, _explicit(spark, sf_dir)), src_file=_name())


def files_healed(spark, sf_dir):
    """The same after one part of the store was cut off and another one lost."""
    store = _explicit(spark, sf_dir)
    parts = list_files(spark, f"{store}/table").where(_name().endswith(".parquet")).orderBy("src_path")
    for k, row in enumerate(parts.limit(2).collect()):
        files, path = open_uri(row.src_path)
        if k:
            files.delete_file(path)
        else:
            data = files.open_input_file(path).read(row.src_bytes // 2)
            with files.open_output_stream(path, compression=None) as out:
                out.write(data)
    return counts.count_by(refresh.read_rows(spark, store), src_file=_name())


def files_refreshed(spark, sf_dir):
    """One server's files are parsed, those of even days rewritten to their even events, and refreshed."""
    lines = sample_log.log_lines(spark, sf_dir).select("event_id", "src_file", "line")
    mine = lines.where(_name().startswith("access_eu-central."))
    logs, store = new_folder(spark, "logs"), new_folder(spark, "store")
    write_files(mine, logs)
    refresh.refresh(spark, store, logs, F.lit(True))
    write_files(mine.where(_name().rlike(r"[02468]\.gz$") & (F.col("event_id") % 8 == 1)), logs)
    refresh.refresh(spark, store, logs, F.lit(True))
    return counts.count_by(refresh.read_rows(spark, store), src_file=_name())


def files_transformed(spark, sf_dir):
    """Rows stored as a user's transform leaves them."""
    store = new_folder(spark, "store")
    chosen = _whole_files() & _name().startswith("access_us-east.")
    refresh.refresh(
        spark, store, log_folder(spark, sf_dir), chosen, transform=lambda rows: rows.withColumn("status", F.col("status") + 1000)
    )
    return counts.count_by(refresh.read_rows(spark, store), status=F.col("status"))


def files_mirror(spark, sf_dir):
    """Bytes per day of the mirror logs in the window, through the cache of their lines."""
    per_day, _ = jobs.mirror_traffic(spark, mirror_folder(spark, sf_dir), new_folder(spark, "cache"), AS_OF)
    return per_day.select("day", F.col("bytes").cast("bigint").alias("bytes"))


FILE_QUERIES = {
    "files_scanned": files_scanned,
    "files_parsed": files_parsed,
    "files_rejected": files_rejected,
    "files_unreadable": files_unreadable,
    "files_clients": files_clients,
    "files_totals": files_totals,
    "files_package_csv": files_package_csv,
    "files_artifact_csv": files_artifact_csv,
    "files_sanitized": files_sanitized,
    "files_anonymized": files_anonymized,
    "files_quick_look": files_quick_look,
    "files_explicit": files_explicit,
    "files_healed": files_healed,
    "files_refreshed": files_refreshed,
    "files_transformed": files_transformed,
    "files_mirror": files_mirror,
}
