"""Pages are listed a bounded part of a batch at a time."""

from pyspark.sql import functions as F

from jobmill.functions.batches import MOST_BYTES
from jobmill.operators import pages


def test_pages_beyond_one_part_keep_their_rows(spark):
    fill = "x" * (MOST_BYTES // 3)
    rows = [(i, None if i == 4 else f"<nav><li><a href='/{i}'>t{i}</a></li></nav><p>{fill if i % 2 else ''}</p>") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id int, html string").coalesce(1)
    read = df.select("page_id", pages.read_page(F.col("html")).alias("p"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    # 251: a function over an iterator, which may give back a batch in parts.
    assert "], 251" in plan
    got = {r.page_id: r.t for r in read.select("page_id", F.col("p.texts")[0]["text"].alias("t")).where("size(p.tags) > 0").collect()}
    assert got == {i: f"t{i}" for i in range(12) if i != 4}
