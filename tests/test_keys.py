"""Null and tied order values and repeated results neither lose nor multiply rows."""

import time

from pyspark.sql import functions as F

from jobmill.functions.salary import parse_salary
from jobmill.functions.text import drop_bullets
from jobmill.operators.enrich import apply_updates, merge_details
from jobmill.operators.load import dedup_first, load_counts, new_rows
from jobmill.streaming.enrich import latest_results

BATCH = "job_url string, title string, company string, raw_location string, at int, note string"


def batch(spark):
    rows = [
        ("a", "t", "c", "l", None, "x"),
        ("b", "t", "c", "l", 1, "x"),
        ("b", "t", "c", "l", 2, "y"),
        ("d", "t", "c", "l", 3, "x"),
        ("d", "t", "c", "l", 3, "y"),
        ("e", "t", "c", "l", 4, "same"),
        ("e", "t", "c", "l", 4, "same"),
        (None, "t", "c", "l", 1, "x"),
    ]
    return spark.createDataFrame(rows, BATCH)


def test_new_rows_and_counts_agree(spark):
    stored = spark.createDataFrame([("z",)], "job_url string")
    got = new_rows(stored, batch(spark), ["at"])
    assert sorted(r.job_url for r in got.collect()) == ["a", "b", "d", "e"]
    assert load_counts(stored, batch(spark), ["at"]).first().inserted == 4
    assert got.columns == BATCH.replace(" string", "").replace(" int", "").split(", ")
    assert sorted(r.job_url for r in dedup_first(batch(spark), "job_url", ["at"]).collect()) == ["a", "b", "d", "e"]


def test_repeated_results_change_a_row_once(spark):
    jobs = spark.sql(
        "SELECT 1L AS id, 'occ' AS site, 'u' AS job_url, cast(NULL AS string) AS description, cast(NULL AS double) AS salary_min,"
        " cast(NULL AS double) AS salary_max, 'PENDING_ENRICHMENT' AS status, cast(NULL AS timestamp_ntz) AS last_updated"
    )
    results = spark.createDataFrame([("u", None, None), ("u", "text", "$9,000"), (None, "lost", None)], "job_url string, description string, salary_raw string")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    done = apply_updates(jobs, results, now).collect()
    assert [(r.status, r.description, r.salary_min) for r in done] == [("NEW", "text", 9000.0)]
    assert merge_details(jobs, results, "id").count() == 1


def test_results_without_time_count_once(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.sql(
        "SELECT 'u' AS job_url, d AS description, cast(NULL AS string) AS salary_raw, cast(NULL AS timestamp_ntz) AS visited_at"
        " FROM VALUES ('one'), ('two'), ('two') AS t(d)"
    )
    log.write.parquet(f"{path}/batch_id=0")
    assert latest_results(spark, path).count() == 1


def test_long_runs_of_blanks_stay_fast(spark):
    began = time.time()
    lines = spark.createDataFrame([("x" + "\n" * 300_000 + "y\n  \n - z",)], "t string")
    assert lines.select(drop_bullets(F.col("t")).alias("t")).first().t.endswith("y\nz")
    blanks = spark.createDataFrame([(" " * 300_000 + "x",)], "t string")
    assert blanks.select(parse_salary(F.col("t")).alias("p")).first().p.salary_min is None
    assert time.time() - began < 20
