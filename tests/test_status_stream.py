"""The status stream against a brute-force reading of all visits, in any order of drops."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from jobmill.operators.load import cascade, load_counts, term_rank
from jobmill.streaming import status

VISITS = "job_url string, description string, salary_raw string, visited_at timestamp_ntz"
START = datetime(2024, 1, 1)


def run(spark, base, drops, delay):
    """The drops one by one, each in a run of its own that goes on from the checkpoint."""
    for i, drop in enumerate(drops):
        spark.createDataFrame(drop, VISITS).repartition(3).write.parquet(f"{base}/in/drop={i}")
        source = spark.readStream.schema(VISITS).parquet(f"{base}/in/drop=*")
        query = status.start(source, f"{base}/log", f"{base}/checkpoint", delay)
        query.awaitTermination()
    return query


def expected(spark, rows):
    hashed = spark.createDataFrame(rows, VISITS).withColumn("tie", F.xxhash64("description", "salary_raw")).collect()
    first = {}
    for r in hashed:
        if r.job_url is not None and r.visited_at is not None:
            place = (r.visited_at, r.description is None, r.tie)
            first[r.job_url] = min(first.get(r.job_url, (place, None)), (place, (r.description, r.salary_raw)), key=lambda x: x[0])
    return {link: values for link, (_, values) in first.items()}


def test_any_order_of_drops_gives_the_earliest_visit(spark, tmp_path):
    draw = random.Random(5)
    rows = [
        (draw.choice([None, "hot", "hot", *"abcdefgh"]), draw.choice([None, "", "one", "two"]), draw.choice([None, "$5"]),
         draw.choice([None, *(START + timedelta(minutes=m) for m in range(30))]))
        for _ in range(600)
    ]
    drops = [rows[:200], rows[200:400], rows[100:300] + rows[400:]]
    run(spark, str(tmp_path), drops, "1 hour")
    got = {r.job_url: (r.description, r.salary_raw) for r in status.settled(spark, f"{tmp_path}/log").collect()}
    assert got == expected(spark, rows)
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.where("(description IS NULL) <> (status = 'ORPHANED')").count() == 0


def test_state_is_forgotten_after_the_delay(spark, tmp_path):
    drops = [[(f"{day}-{i}", "text", None, START + timedelta(days=day)) for i in range(50)] for day in range(4)]
    query = run(spark, str(tmp_path), drops, "1 hour")
    held = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert held <= 100
    assert status.settled(spark, f"{tmp_path}/log").count() == 200


def test_terms_win_in_their_configured_order(spark):
    first = spark.createDataFrame([(1, "u", "b"), (2, "v", "z")], "id int, job_url string, term string")
    second = spark.createDataFrame([(3, "u", "a"), (4, "v", "a"), (5, "w", None)], "id int, job_url string, term string")
    both = cascade([("one", first), ("two", second)]).withColumn("rank", term_rank(F.col("term"), ["b", "a"]))
    assert [r["rank"] for r in both.orderBy("id").collect()] == [1, 3, 2, 2, 3]
    counts = load_counts(spark.createDataFrame([], "job_url string"), both, ["rank", "load_order", "id"], "load_source")
    assert {r.load_source: (r.inserted, r.skipped) for r in counts.collect()} == {"one": (1, 1), "two": (2, 1)}


def test_links_that_share_a_state_keep_their_own_places(spark, tmp_path):
    def at(minutes):
        return START + timedelta(minutes=minutes)

    drops = [
        [("a", "late", None, at(50)), ("b", "one", None, at(0)), ("c", None, "$1", at(30))],
        [("a", "early", None, at(40)), ("c", "two", None, at(45)), ("z", "far", None, at(500))],
        [("a", "again", None, at(480)), ("d", "new", None, at(490))],
    ]
    base = str(tmp_path)
    for i, drop in enumerate(drops):
        spark.createDataFrame(drop, VISITS).write.parquet(f"{base}/in/drop={i}")
        source = spark.readStream.schema(VISITS).parquet(f"{base}/in/drop=*")
        rows = status.changes(source, "1 hour", buckets=1)
        query = rows.writeStream.foreachBatch(
            lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/log/{status.BATCH}={n}")
        ).outputMode("update").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    log = sorted((r.job_url, r.description or "", r.status) for r in spark.read.parquet(f"{base}/log").collect())
    # The state of "a" was forgotten before its third visit, which is logged again.
    assert log == [
        ("a", "again", "NEW"), ("a", "early", "NEW"), ("a", "late", "NEW"), ("b", "one", "NEW"), ("c", "", "ORPHANED"),
        ("d", "new", "NEW"), ("z", "far", "NEW"),
    ]
