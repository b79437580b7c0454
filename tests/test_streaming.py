from datetime import date, datetime

from pyspark.sql import functions as F

from hitledger.operators.parse import parse_lines
from hitledger.sources.textscan import text_lines
from hitledger.streaming import ingest
from test_sources_and_refresh import name_of, put
from tests_lines import LINES


def test_ingest_picks_up_new_files_once(spark, tmp_path):
    logs, table, checkpoint = (str(tmp_path / n) for n in ("logs", "table", "checkpoint"))
    (tmp_path / "logs").mkdir()
    run = lambda: ingest.ingest_available(ingest.parsed_stream(ingest.stream_lines(spark, logs), b"k"), table, checkpoint)
    put(logs, name_of("kr", 20240110), LINES[:5])
    run()
    assert spark.read.parquet(table).where("record = 'row'").count() == 4
    assert spark.read.parquet(table).where("record = 'reject'").count() == 1
    put(logs, name_of("kr", 20240111, "zst"), LINES[5:])
    run()
    run()
    everything = spark.read.parquet(table)
    assert everything.count() == len(LINES)
    rows = everything.where("record = 'row'")
    batch = parse_lines(text_lines(spark, logs), "value", ["src_file"], F.col("src_file"))
    columns = batch.columns
    assert sorted(map(str, rows.select(columns).collect())) == sorted(map(str, batch.collect()))
    assert rows.where("hll_hash is null").count() == 0
    assert {r.log_date for r in rows.select("log_date").collect()} == {date(2024, 1, d) for d in (8, 9, 10, 11)}


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    logs = str(tmp_path / "logs")
    put(logs, "a.log", LINES[:4])
    put(logs, "b.log", LINES[4:])
    stream = parse_lines(ingest.stream_lines(spark, logs, 1, F.lit(True), "*"))
    got = ingest.run_to_folder(ingest.daily_counts(stream), "update", keys=["day"])
    want = ingest.daily_counts(parse_lines(text_lines(spark, logs)))
    assert sorted(got.collect()) == sorted(want.collect())
    assert {r.day: r.n for r in want.collect()} == {
        date(2024, 1, 8): 1, date(2024, 1, 9): 1, date(2024, 1, 10): 3, date(2024, 1, 11): 2,
    }


def test_every_batch_counts_and_foreign_files_do_not(spark, tmp_path):
    logs = tmp_path / "logs"
    (logs / "older").mkdir(parents=True)
    good = [x for x in LINES if x.startswith("1")][:4]
    for day, folder in ((10, logs), (11, logs), (12, logs / "older"), (13, logs / "older")):
        put(folder, name_of("kr", 20240100 + day), good)
    put(logs, "other.txt", good, "log")
    put(logs, "access_eu.example.org.log-20240110.gz", good)
    stream = ingest.stream_lines(spark, str(logs), files_per_batch=1)
    got = ingest.run_to_folder(parse_lines(stream, "value", ["src_file"]), "append")
    assert got.count() == 16
    assert {r.src_file for r in got.select("src_file").collect()} == {name_of("kr", 20240100 + d) for d in (10, 11, 12, 13)}


def test_a_stream_without_input_is_empty(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    stream = parse_lines(ingest.stream_lines(spark, str(tmp_path / "logs")))
    assert ingest.run_to_folder(stream, "append").count() == 0


def test_days_are_utc_in_any_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),), (datetime(2024, 3, 10, 23, 59),), (None,)], "time_utc timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [tuple(r) for r in ingest.daily_counts(df).collect()] == [(date(2024, 3, 10), 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_late_lines_beyond_the_watermark_are_dropped(spark, tmp_path):
    """Closed days come out once; a line that arrives after its day closed is not counted."""
    (tmp_path / "logs").mkdir()
    logs = str(tmp_path / "logs")
    names = iter("abcd")

    def land(*days):
        lines = [LINES[0].replace("2024-01-08", f"2024-01-{d:02d}") for d in days]
        put(logs, f"{next(names)}.log", lines)

    counts = ingest.daily_counts(parse_lines(ingest.stream_lines(spark, logs, 1, F.lit(True), "*")))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        query = counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query.outputMode("append").trigger(availableNow=True).start().awaitTermination()

    for days in [(8, 8, 9), (20,), (8, 21)]:
        land(*days)
        run()
    got = {r.day: r.n for r in spark.read.parquet(out).collect()}
    assert got == {date(2024, 1, 8): 2, date(2024, 1, 9): 1}
