"""Stored keys by bucket: batches meet earlier ones, other buckets are not read, folders merge."""

import subprocess
import sys

from pyspark.sql import functions as F

from jobmill.streaming import export, load

ROWS = "id int, job_url string, title string, company string, raw_location string"


def rows(spark, *pairs):
    return spark.createDataFrame([(i, u, "t", "c", "l") for i, u in pairs], ROWS)



def test_batches_with_shared_keys(spark, tmp_path):
    base = str(tmp_path)
    for pairs in ([(1, "a"), (2, "b"), (3, "a")], [(4, "b"), (5, "c"), (6, None)], [(7, "c"), (8, "old"), (9, "d")]):
        rows(spark, *pairs).coalesce(1).write.mode("append").parquet(f"{base}/in")
        drops = export.read_drops(spark, f"{base}/in", rows(spark, *pairs).schema, files_per_batch=1)
        seed = spark.createDataFrame([("old",), (None,), ("old",)], "job_url string")
        load.start_insert(drops, f"{base}/table", f"{base}/checkpoint", ["id"], seed=seed, buckets=8).awaitTermination()
    got = load.read_table(spark, f"{base}/table", rows(spark, (1, "a")).schema)
    assert sorted((r.id, r.job_url) for r in got.collect()) == [(1, "a"), (2, "b"), (5, "c"), (9, "d")]
    keys = spark.read.parquet(f"{base}/table-keys")
    assert sorted(r.job_url for r in keys.collect()) == ["a", "b", "c", "d", "old"]
    load.compact_keys(spark, f"{base}/table-keys", 1, f"{base}/merged", "job_url")
    merged = spark.read.parquet(f"{base}/merged")
    assert sorted((r.batch_id, r.job_url) for r in merged.collect()) == [(1, "a"), (1, "b"), (1, "c"), (1, "old"), (2, "d")]


def test_a_batch_reads_its_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "keys")
    all_keys = spark.range(4_000).select(F.concat(F.lit("u"), "id").alias("job_url"))
    load.write_keys(all_keys, path, 0, "job_url", 64)
    batch = spark.createDataFrame([("u5",), ("u5",), (None,)], "job_url string")
    found = load.stored_keys(spark, path, batch, "job_url", 1, 64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert 0 < found.count() < 200 and found.where("job_url = 'u5'").count() == 1
    assert load.stored_keys(spark, path, batch.limit(0), "job_url", 1, 64).count() == 0
    assert load.stored_keys(spark, str(tmp_path / "none"), batch, "job_url").count() == 0


def test_a_session_started_elsewhere_finds_the_package(tmp_path):
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from jobmill.session import build_session\n"
        "s = build_session('local[1]', 'elsewhere')\n"
        "from jobmill.streaming.status import earliest, VISIT\n"
        "df = s.sql(\"SELECT 'u' AS job_url, timestamp_seconds(id) AS visited_at, false AS no_text, id AS tie, 'd' AS description, 's' AS salary_raw FROM range(5)\")\n"
        "print('rows', df.coalesce(1).mapInPandas(earliest, VISIT).count())\n"
    )
    home = __file__.rsplit("/tests/", 1)[0]
    done = subprocess.run([sys.executable, "-c", code, home], cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "rows 1" in done.stdout, done.stderr[-2000:]
