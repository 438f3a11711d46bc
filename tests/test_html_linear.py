"""Pages with openers that nothing closes: the same text as the plain patterns, in linear time."""

import html as entities
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from jobmill.functions import html

PARTS = ["<!--", "-->", "<!-->", "<script", "<script>", "</script>", "</SCRIPT >", "</script ", "<style>", "</style>", "<p>", "<p", ">", "</p>", "<", "a", "é", " ", "\n", "<scripty>", "<title>", "</title>"]


def plain_text(page):
    """The patterns as they read, without care for time."""
    bare = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", "\x01", page, flags=re.I | re.S)
    bare = re.sub(r"</?[A-Za-z!?][^>]*>", "\x01", bare)
    return re.sub(r"\s*\x01[\s\x01]*", " ", entities.unescape(bare)).strip()


def plain_title(page):
    found = re.search(r"<title\b[^>]*>(.*?)</title\s*>", page, flags=re.I | re.S)
    return plain_text(found[1] if found else "") if re.search(r"<title\b", page, flags=re.I) else None


def test_random_pages(spark):
    draw = random.Random(11)
    pages = [("".join(draw.choices(PARTS, k=draw.randint(0, 14))),) for _ in range(4_000)]
    got = spark.createDataFrame(pages, "p string").select(
        "p", html.visible_text(F.col("p")).alias("t"), html.inner_text(F.col("p"), "title").alias("h")
    ).collect()
    assert len(got) == 4_000
    for row in got:
        assert (row.t, row.h) == (plain_text(row.p), plain_title(row.p)), row.p


@pytest.mark.parametrize("opener", ["<!--", "<script ", "<style>", "<p ", "<title>"])
def test_unclosed_openers_are_linear(spark, opener):
    began = time.time()
    page = spark.range(1).select(F.concat(F.lit("<b>x</b>"), F.repeat(F.lit(opener), 200_000)).alias("p"))
    text, title = page.select(html.visible_text(F.col("p")), html.inner_text(F.col("p"), "title")).first()
    assert text.startswith("x") and title in (None, "")
    assert time.time() - began < 20


def test_no_page(spark):
    page = spark.range(1).select(F.lit(None).cast("string").alias("p"))
    assert tuple(page.select(html.visible_text(F.col("p")), html.inner_text(F.col("p"), "h1")).first()) == (None, None)
