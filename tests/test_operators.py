"""Operators against brute force on small frames, with hot keys where skew matters."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jobmill import schema as S
from jobmill.functions.text import clean_description
from jobmill.operators import audit, enrich, features, frontier, language, load, medians, nlp, pages, rank, skew, streaks
from jobmill.plans.inputs import moment
from jobmill.sources import csv_files, lake
from jobmill.sources.tables import postings, table
from jobmill.streaming import export, load as stream_load


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_left_join_hot_equals_plain_join(spark):
    left = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE cast(id AS string) END AS k")
    right = spark.createDataFrame([("hot", 1), ("1", 2), ("5", 3), ("absent", 4)], "k string, v int")
    for task_rows in (skew.TASK_ROWS, 150):
        got = skew.left_join_hot(left, right, "k", F.col("id"), task_rows)
        assert rows(got, "id", "k", "v") == rows(left.join(right, "k", "left"), "id", "k", "v")
    # 1,000 rows in tasks of 150 need seven places; no other key has more than one row.
    found = spark.range(1).select(F.xxhash64(F.lit("hot")).alias("h")).first().h
    assert [tuple(r) for r in skew.hot_keys(left, "k", 150).collect()] == [(found, 7)]
    assert skew.hot_keys(left, "k").count() == 0


def test_streaks_of_one_key_that_holds_all_rows(spark):
    """Chunks follow the count of rows, not the time: all rows share one key and nearly one hour."""
    df = spark.range(20_000).selectExpr(
        "'all' AS k", "CASE WHEN id % 97 = 0 THEN NULL ELSE timestamp_seconds(id div 7) END AS t", "id AS i",
        "CASE WHEN xxhash64(id) % 11 = 0 THEN 'ok' WHEN xxhash64(id) % 5 = 0 THEN 'empty' ELSE 'fail' END AS o",
    )
    run, expected = 0, []
    for row in sorted(df.collect(), key=lambda r: (r.t is not None, r.t, r.i) if r.t else (False, 0, r.i)):
        if row.o != "empty":
            run = run + 1 if row.o == "fail" else 0
            if run and run % 3 == 0:
                expected.append(("all", row.i, run))
    for task_rows in (streaks.TASK_ROWS, 1_000):
        assert rows(streaks.failure_trips(df, "k", "t", "i", "o", task_rows=task_rows), "k", "i", "run_length") == sorted(expected, key=str)
    sizes = [r["count"] for r in streaks.ranged(df, ["k", "t", "i"], 1_000).groupBy(streaks.CHUNK).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2_500
    assert streaks.failure_trips(df.limit(0), "k", "t", "i", "o").count() == 0


def test_streaks_of_rows_without_a_key_are_one_key(spark):
    df = spark.createDataFrame([(None, i, "fail") for i in range(7)], "k int, t int, o string").withColumn("i", F.col("t"))
    assert rows(streaks.failure_trips(df, "k", "t", "i", "o", task_rows=2), "i", "run_length") == [(2, 3), (5, 6)]


def test_insert_counts_add_up_and_first_wins(spark):
    batch = spark.createDataFrame(
        [(3, "a", "t3"), (1, "a", "t1"), (2, "b", "t2"), (4, None, "t4"), (5, "c", "t5")], "id int, job_url string, title string"
    )
    stored = spark.createDataFrame([("b", "old")], "job_url string, title string")
    assert rows(load.new_rows(stored, batch, ["id"]), "id", "job_url") == [(1, "a"), (5, "c")]
    counts = load.load_counts(stored, batch, ["id"]).first()
    assert (counts.inserted, counts.skipped, counts.rejected) == (2, 2, 1)
    after = load.insert_new(stored, batch, ["id"])
    assert rows(after, "job_url", "title") == [("a", "t1"), ("b", "old"), ("c", "t5")]
    assert load.insert_new(after, batch, ["id"]).count() == after.count()
    assert load.dedup_first(batch, "job_url", ["title", "id"]).count() == 3


def test_failure_trips(spark):
    start = datetime(2024, 1, 1)
    one = [(1, start + timedelta(minutes=20 * i), i, o) for i, o in enumerate("FFFFFFSFFF")]
    rng = random.Random(7)
    many = [(2 + (i % 3 == 0), start + timedelta(minutes=rng.randrange(6000)), 100 + i, rng.choice("FFFFSE")) for i in range(900)]
    names = {"F": "fail", "S": "ok", "E": "empty"}
    data = [(k, t, i, names[o]) for k, t, i, o in one + many]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, i int, o string")
    expected = []
    for key in {r[0] for r in data}:
        run = 0
        for _, _, i, o in sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2])):
            if o == "empty":
                continue
            run = run + 1 if o == "fail" else 0
            if run and run % 3 == 0:
                expected.append((key, i, run))
    got = rows(streaks.failure_trips(df, "k", "t", "i", "o"), "k", "i", "run_length")
    assert got == sorted(expected, key=str)
    assert [g[1] for g in got if g[0] == 1] == [2, 5, 9]


def test_followup_scores(spark):
    today = moment("2024-01-22 00:00:00")
    df = spark.createDataFrame(
        [
            (1, "APPLIED", datetime(2024, 1, 8), datetime(2024, 1, 1)),
            (2, "INTERVIEW", None, None),
            (3, "SCREENING", datetime(2024, 1, 8, 18), None),
            (4, "NEW", datetime(2023, 1, 8), None),
        ],
        "id int, status string, last_updated timestamp_ntz, applied_date timestamp_ntz",
    ).withColumns({"company": F.lit("c"), "title": F.lit("t")})
    got = [(r.id, r.days_since_update, r.followup_score) for r in rank.followup_scores(df, today).collect()]
    assert got == [(1, 14, 13), (3, 13, 8), (2, None, 0)]


def test_enrichment(spark):
    jobs = spark.createDataFrame(
        [
            (1, "occ", "u1", S.PENDING, None, None, None),
            (2, "occ", "u2", S.PENDING, None, 5.0, 6.0),
            (3, "indeed", "u3", S.PENDING, None, None, None),
            (4, "occ", "u4", S.PENDING, None, None, None),
            (5, "computrabajo", "u5", S.PENDING, None, None, None),
        ],
        "id int, site string, job_url string, status string, description string, salary_min double, salary_max double",
    ).withColumn("last_updated", moment("2024-01-01 00:00:00"))
    found = spark.createDataFrame(
        [("u1", "d1", "$1,000 - $2,000"), ("u2", "d2", "$9"), ("u3", "d3", None), ("u4", None, None), ("zz", "d", None)],
        "job_url string, description string, salary_raw string",
    )
    after = enrich.apply_updates(jobs, found, moment("2024-02-01 00:00:00"))
    assert rows(after, "id", "status", "description", "salary_min", "salary_max") == [
        (1, "NEW", "d1", 1000.0, 2000.0),
        (2, "NEW", "d2", 5.0, 6.0),
        (3, S.PENDING, None, None, None),
        (4, S.ORPHANED, None, None, None),
        (5, S.PENDING, None, None, None),
    ]
    totals = enrich.run_totals(jobs, found).first()
    assert (totals.enriched, totals.orphaned, totals.remaining) == (2, 1, 1)
    assert [r.id for r in enrich.queue(jobs, 2).collect()] == [5, 1]
    assert rows(enrich.batches(jobs, 100, 2), "id", "batch_no", "batch_count") == [(1, 1, 2), (2, 1, 2), (4, 2, 2), (5, 1, 1)]


def test_pagination_and_caps(spark):
    df = spark.createDataFrame(
        [("a", p, p == 3, p != 9) for p in range(1, 6)] + [("b", p, False, p < 2) for p in range(1, 5)],
        "k string, page int, gone boolean, more boolean",
    )
    got = rank.until_pagination_stops(df, "k", "page", "gone", "more", "page")
    assert rows(got, "k", "page") == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert rank.cap_per_group(df, ["k"], ["page"], 2).count() == 4
    assert rank.cap_total(df, ["k", "page"], 3).count() == 3


def test_language_held_out(spark, folder):
    documents = table(spark, folder, "documents").where("n_chars >= 200")
    model = language.train(documents.where("doc_id % 2 = 0"), "text", "lang")
    other = documents.where("doc_id % 2 = 1")
    hits = other.select((model.language(F.col("text")) == F.col("lang")).alias("hit")).agg(F.avg(F.col("hit").cast("int"))).first()[0]
    assert hits > 0.97
    short = spark.createDataFrame([("corto",), (None,), ("1234567890 1234567890 12345",)], "t string")
    got = language.detect(short, "t", F.lit(True), model).select("idioma_det").collect()
    assert [r[0] for r in got] == ["otro"] * 3


def test_lemmas_follow_stop_words(spark):
    df = spark.createDataFrame(
        [(1, "Buscamos ingeniero con experiencia en modelos de lenguaje natural", "es", "Modelos", False), (2, None, "en", None, True)],
        "id int, descripcion_limpia string, idioma_det string, title string, es_vacio boolean",
    )
    lemmas = spark.createDataFrame([("es", "modelos", "modelo"), ("es", "natural", "para")], "lang string, token string, lemma string")
    out = {r.id: r for r in nlp.add_nlp_columns(df, lemmas).collect()}
    assert out[1].descripcion_nlp == "ingeniero modelo lenguaje para"
    assert out[1].texto_nlp == "modelo ingeniero modelo lenguaje para"
    assert (out[1].n_palabras_nlp, out[1].es_vacio_nlp, out[2].texto_nlp) == (4, True, "")


LISTING = """<div class="box_offer x"><h2><a class="js-o-link" href="/oferta/1"> Dev <b>A</b></a></h2>
<div class="fs16"><p class="mt5"><span>4.5</span><a>Acme</a></p><p class="mt5">León</p></div><p class="fc_aux">Hoy</p>
<div class="fs12 mt15"><span class="dIB">$10,000 - $12,000</span><span class="dIB"><span class="i_home"></span>Remoto</span>
<span class="dIB"><span class="i_home_office"></span>Mixto</span></div></div>
<div class="box_offer"><h2>sin enlace</h2></div><span class="b_primary buildLink" data-path="p2"></span>"""
OCC = """<div data-offers-grid-offer-item-container data-id="77"><h2 class="text-lg text-grey-900">Data</h2>
<span class="mr-2 text-grey-900 font-base font-light">$5,000</span><div class="col-span-10"><div class="h-[21px]">Beta</div></div>
<div class="no-alter-loc-text"><p>CDMX</p></div><span class="mr-2 text-sm font-light">Ayer</span></div>"""


def test_listing_cards(spark):
    stored = spark.createDataFrame([(1, LISTING), (2, "<p>nada</p>")], "page_id int, html string")
    got = pages.listing_rows(pages.page_cards(stored, "page_id", pages.COMPUTRABAJO), pages.COMPUTRABAJO).orderBy("card_no").collect()
    first = got[0]
    assert len(got) == 2 and got[1].title is None and got[1].job_url is None
    assert (first.title, first.company, first.raw_location, first.date_posted) == ("DevA", "Acme", "León", "Hoy")
    assert (first.job_url, first.salary_min, first.salary_max) == ("https://mx.computrabajo.com/oferta/1", 10000.0, 12000.0)
    assert (first.job_type, first.has_next, first.currency) == ("Híbrido", True, "MXN")
    occ = spark.createDataFrame([(1, OCC)], "page_id int, html string")
    card = pages.listing_rows(pages.page_cards(occ, "page_id", pages.OCC), pages.OCC, remote=True).first()
    assert (card.job_url, card.title, card.company, card.raw_location) == ("https://www.occ.com.mx/empleo/oferta/77/", "Data", "Beta", "CDMX")
    assert (card.salary_min, card.salary_max, card.job_type, card.date_posted) == (5000.0, 5000.0, "Remoto", "Ayer")


@pytest.mark.parametrize(
    "profile,html,text",
    [
        (pages.COMPUTRABAJO, "<p class='mbB'>x</p><h3 id='js_oferta'>o</h3><p class='mbB'> a <b>b</b></p>", "a\nb"),
        (pages.COMPUTRABAJO, "<p class='mbB'>solo</p>", "solo"),
        (pages.OCC, "<div itemprop='description'>i</div><div class='break-words'>z</div>", "i"),
        (pages.OCC, "<div>q<p>Descripción:</p><p>larga</p></div>", "q\nDescripción:\nlarga"),
        (pages.OCC, "<div class='break-words'>z</div>", "z"),
        (pages.OCC, "<p>nada $ 1,500 al mes</p>", None),
    ],
)
def test_details(spark, profile, html, text):
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = pages.page_details(df, "page_id", profile).first()
    assert got.description == text
    assert got.salary_raw == ("$ 1,500" if "1,500" in html else None)


def test_export_runs_and_checkpoint(spark, folder, tmp_path):
    jobs = postings(spark, folder).cache()
    path, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    half = jobs.where("date_scraped < timestamp_ntz'2024-01-01 06:00:00'")
    first = lake.run_export(half, path, checkpoint).first()
    second = lake.run_export(jobs, path, checkpoint).first()
    third = lake.run_export(jobs, path, checkpoint).first()
    everything = lake.export_rows(jobs)
    dated = everything.where("date_scraped IS NOT NULL").count()
    assert first.records > 0 and first.records + second.records == dated and third.records == 0
    assert lake.read_checkpoint(spark, checkpoint) == second.checkpoint
    assert lake.read_checkpoint(spark, str(tmp_path / "none")) is None
    assert len(lake.run_export(jobs, path, str(tmp_path / "none"), dry_run=True).collect()) <= 3
    csv = lake.run_export(jobs, str(tmp_path / "csv"), str(tmp_path / "c2"), fmt="csv").first()
    assert csv.records == everything.count() and csv.checkpoint == second.checkpoint


def test_unknown_day(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "id int, date_scraped timestamp_ntz")
    lake.write_partitions(df, str(tmp_path / "p"))
    back = lake.read_partitions(spark, str(tmp_path / "p"), df.schema)
    assert back.first().ingestion_date == "unknown"
    assert lake.verify(df, back).first().verified


def test_csv_roundtrip_of_hard_values(spark, tmp_path):
    values = [("a,b", 'say "x"\nline', True), (" blanks ", "NA", False), ("", None, None), ("\\n", "ñ", True)]
    df = spark.createDataFrame(values, "a string, b string, f boolean")
    csv_files.write_csv(df, str(tmp_path / "c"))
    back = csv_files.read_text_csv(spark, str(tmp_path / "c"), ["a", "b", "f"])
    assert rows(back, "a", "b", "f") == sorted(
        [("a,b", 'say "x"\nline', "True"), (" blanks ", None, "False"), (None, None, None), ("\\n", "ñ", "True")], key=str
    )
    csv_files.write_report_csv(df, str(tmp_path / "r"), files=1)
    part = next((tmp_path / "r").glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfa,b")


def test_stream_second_run_takes_only_new_files(spark, folder, tmp_path):
    jobs = postings(spark, folder)
    drop, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    jobs.where("site = 'indeed'").write.parquet(drop)
    read = lambda: export.read_drops(spark, drop, jobs.schema)
    export.start_export(read(), out, mark).awaitTermination()
    export.start_export(read(), out, mark).awaitTermination()
    schema = lake.export_rows(jobs).schema
    once = lake.read_partitions(spark, out, schema).count()
    assert once == lake.export_rows(jobs.where("site = 'indeed'")).count()
    jobs.where("site <> 'indeed'").write.mode("append").parquet(drop)
    export.start_export(read(), out, mark).awaitTermination()
    assert rows(lake.read_partitions(spark, out, schema), "id") == rows(lake.export_rows(jobs), "id")


def test_stream_insert_is_idempotent(spark, tmp_path):
    drop, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "id int, job_url string, title string"
    spark.createDataFrame([(1, "a", "t"), (2, "a", "u"), (3, "b", "v")], schema).write.parquet(drop)
    shape = spark.read.parquet(drop).schema
    run = lambda m: stream_load.start_insert(export.read_drops(spark, drop, shape), out, m, ["id"]).awaitTermination()
    run(mark)
    spark.createDataFrame([(4, "b", "w"), (5, "c", "x")], schema).write.mode("append").parquet(drop)
    run(mark)
    expected = [(1, "a"), (3, "b"), (5, "c")]
    assert rows(stream_load.read_table(spark, out, shape), "id", "job_url") == expected
    watermarked = stream_load.first_within(
        spark.readStream.format("rate").load().withColumn("job_url", F.lit("a")), "timestamp", "1 hour"
    )
    assert watermarked.isStreaming


def test_search_config_and_frontier(spark):
    table = spark.createDataFrame(
        [("w1", "Data Engineer", "México", "n1"), ("default", "Cloud Engineer", "México", "n2"), ("w1", "QA", "México", "n1")],
        "worker string, search_term string, location string, industry_niche string",
    )
    assert rows(frontier.search_config(table, "w1"), "search_term") == [("Data Engineer",), ("QA",)]
    assert rows(frontier.search_config(table, "nobody"), "search_term") == [("Cloud Engineer",)]
    found = frontier.search_pages(table.where("worker = 'default'"), "occ", pages=2, remote=True)
    assert rows(found, "url") == [
        (f"https://www.occ.com.mx/empleos/de-Cloud-Engineer/en-mexico-y-teletrabajo/?page={n}",) for n in (1, 2)
    ]


def test_audit_of_empty_table(spark):
    empty = spark.createDataFrame([], "title string, job_url string, salary_min double")
    assert tuple(audit.summary(empty).first()) == (0, 0, 0, 0.0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, folder):
    jobs = postings(spark, folder, dates=False)
    cleaned = jobs.select("id", clean_description(F.col("description")).alias("c"))
    text = plan(cleaned)
    assert "Python" not in text and "Join" not in text
    capped = plan(rank.cap_per_group(jobs.select("id", "career"), ["career"], ["id"], 5))
    assert "WindowGroupLimit" in capped
    assert "TakeOrderedAndProject" in plan(enrich.queue(jobs))
    assert "Window" not in plan(audit.language_shares(jobs.withColumn("e", F.lit(False)), "lang", "e"))
    # A filter on the cleaned text must not multiply the cleaning chain.
    filtered = plan(cleaned.where("length(c) > 3"))
    assert filtered.count("https?") <= 2 * text.count("https?") + 2


def test_lemmas_in_place_equal_the_join(spark):
    rows = [(1, ["gatos", "perro"], "es"), (1, ["x", "gatos"], "en"), (None, [], "es"), (None, ["gatos"] * 3, None), (2, ["cats", "gatos"], "en")]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, lang string")
    lemmas = spark.createDataFrame(
        [("es", "gatos", "gato"), ("es", "gatos", "gata"), ("en", "cats", "cat"), ("en", "x", "x")], "lang string, token string, lemma string"
    )
    expected = sorted(map(str, [(1, ["gata", "perro"]), (1, ["x", "gatos"]), (None, []), (None, ["gata"] * 3), (2, ["cat", "gatos"])]))
    for most in (100, 0):
        got = nlp.lemmatize(df, "tokens", "lang", lemmas, most).select("id", "tokens").collect()
        assert sorted(str(tuple(r)) for r in got) == expected
    assert nlp.lemmatize(df.limit(0), "tokens", "lang", lemmas).count() == 0
    plan = nlp.lemmatize(df, "tokens", "lang", lemmas)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_a_failed_check_leaves_commits_and_checkpoint(spark, folder, tmp_path, monkeypatch):
    from jobmill.sources import lake

    jobs = postings(spark, folder)
    path, checkpoint = str(tmp_path / "lake"), str(tmp_path / "mark")
    early = jobs.where("date_scraped <= TIMESTAMP_NTZ'2024-01-01 12:00:00'")
    lake.run_export(early, path, checkpoint, run="one")
    before = lake.read_checkpoint(spark, checkpoint)
    schema = lake.export_rows(jobs).schema
    held = lake.read_committed(spark, path, schema).count()
    write = lake.write_partitions
    with monkeypatch.context() as m:
        m.setattr(lake, "write_partitions", lambda rows, *a, **k: write(rows.where("id % 7 <> 0"), *a, **k))
        with pytest.raises(lake.ExportMismatch):
            lake.run_export(jobs, path, checkpoint, run="two")
    assert lake.read_checkpoint(spark, checkpoint) == before
    assert lake.read_committed(spark, path, schema).count() == held
    assert {r[0] for r in lake.commits(spark, path).select(lake.RUN).distinct().collect()} == {"one"}
    # A run that ends between commit and checkpoint is finished by the next one.
    with monkeypatch.context() as m:
        m.setattr(lake, "write_checkpoint", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.run_export(jobs, path, checkpoint, run="three")
    assert lake.read_checkpoint(spark, checkpoint) == before
    assert lake.run_export(jobs, path, checkpoint, run="four").first()["records"] == 0
    assert lake.read_checkpoint(spark, checkpoint) > before
    later = lake.export_rows(jobs).where(F.col("date_scraped") > before).count()
    assert lake.read_committed(spark, path, schema).count() == held + later


@pytest.mark.parametrize("unseen", ["fr", "de"])
def test_texts_of_an_unseen_language_are_of_none(spark, folder, unseen):
    docs = spark.read.parquet(folder.replace("sf0.001", "sf0.01") + "/documents.parquet")
    model = language.train_open(docs.where(F.col("lang") != unseen), "text", "lang")
    found = docs.select("lang", model.language(F.col("text")).alias("found")).collect()
    assert unseen not in model.languages
    other = [r["found"] is None for r in found if r["lang"] == unseen]
    lost = [r["found"] != r["lang"] for r in found if r["lang"] != unseen]
    assert sum(other) >= 0.9 * len(other) and sum(lost) <= 0.05 * len(lost)


def test_open_set_of_odd_tables(spark):
    rows = [("uno dos tres cuatro", "es"), (None, "es"), ("x", None), ("123", "en"), ("", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for table_ in (docs, docs.limit(0)):
        model = language.train_open(table_, "text", "lang")
        assert docs.select(model.language(F.col("text"))).count() == 5


def test_state_of_the_bounded_stream(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").alias("k"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id"))).alias("ts")
    )
    for i in range(4):
        part = rows.where((F.col("k") >= 1000 * i) & (F.col("k") < 1000 * (i + 1)))
        late = rows.where((F.col("k") >= 1000 * (i - 1)) & (F.col("k") < 1000 * i))
        part.unionByName(late).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    drops = export.read_drops(spark, str(tmp_path / "in"), rows.schema, files_per_batch=1)
    stream = stream_load.start_first_within(drops, str(tmp_path / "out"), str(tmp_path / "mark"), "ts", "2 days", "k")
    stream.awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == written.select("k").distinct().count() == 4000
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in stream.recentProgress if p["stateOperators"]]
    assert max(sizes) < 3000 and sizes[-1] < 1500


def test_sketched_medians_merge_days(spark, tmp_path):
    """Medians of merged days stay within the rank error; an added day writes its own folder alone."""
    path = str(tmp_path / "days")
    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 1000 = 1 THEN 'rare' ELSE 'hot' END AS g",
        "CASE WHEN id % 50 <> 0 THEN cast(pmod(xxhash64(id), 5000) AS int) END AS v",
        "date_add(DATE '2024-01-01', cast(id % 4 AS int)) AS d",
    )
    early = df.where("d < DATE '2024-01-04'")
    medians.store_days(medians.sketches(early, "g", "v", F.col("d")), path)
    first = {f.name: f.stat().st_mtime_ns for f in tmp_path.glob("days/day=*/*.parquet")}
    late = df.where("d = DATE '2024-01-04'")
    for _ in range(2):
        medians.store_days(medians.sketches(late, "g", "v", F.col("d")), path)
    after = {f.name: f.stat().st_mtime_ns for f in tmp_path.glob("days/day=*/*.parquet")}
    assert first.items() <= after.items() and len(list(tmp_path.glob("days/day=*"))) == 4
    found = medians.medians(medians.read_days(spark, path))
    got = {r.grp: r for r in medians.checked(df, "g", "v", found).collect()}
    assert set(got) == {None, "rare", "hot"} and all(r.exact_rank_fits for r in got.values())
    assert sum(r.n for r in got.values()) == df.where("v IS NOT NULL").count()
    wrong = found.withColumn("median_number", F.col("median_number") + 200)
    assert not any(r.exact_rank_fits for r in medians.checked(df, "g", "v", wrong).collect())
    assert medians.medians(medians.sketches(df.limit(0), "g", "v", F.col("d"))).count() == 0


def test_topics_find_planted_vocabularies(spark):
    """Texts of two vocabularies without a common word: a topic's heaviest words come from one of them."""
    df = spark.range(400).selectExpr(
        "id", "transform(sequence(1, 12), i -> concat(if(id % 2 = 0, 'red', 'blue'), cast(pmod(xxhash64(id, i), 6) AS string))) AS tokens"
    )
    found = features.lda_topics(df, "tokens", topics=2, words=6, rounds=40).collect()
    topics = {t: [r for r in found if r.topic == t] for t in (0, 1)}
    assert sorted(len({r.term for r in rs}) for rs in topics.values()) == [6, 6]
    assert {frozenset(r.term.rstrip("012345") for r in rs) for rs in topics.values()} == {frozenset({"red"}), frozenset({"blue"})}
    for rs in topics.values():
        weights = [r.weight for r in sorted(rs, key=lambda r: r["rank"])]
        assert [r["rank"] for r in sorted(rs, key=lambda r: r["rank"])] == list(range(1, 7)) and weights == sorted(weights, reverse=True)


def test_clusters_follow_direction_not_length(spark):
    df = spark.range(300).selectExpr(
        "id", "transform(sequence(0, 2), i -> (1.0D + id % 7) * (if(i = id % 3, 1.0D, 0.0D) + 0.01D * pmod(xxhash64(id, i), 5))) AS v"
    )
    got = features.cosine_clusters(df, "id", "v", k=3).collect()
    assert len(got) == 300 and len({r.id for r in got}) == 300
    assert len({(r.id % 3, r.cluster) for r in got}) == 3 and len({r.cluster for r in got}) == 3


def test_csv_files_are_bounded(spark, tmp_path):
    df = spark.range(1_000).coalesce(1).select(F.col("id").cast("string").alias("id"), F.lit("a\nb").alias("t"))
    csv_files.write_csv(df, str(tmp_path / "c"), rows_per_file=300)
    assert len(list(tmp_path.glob("c/*.csv"))) == 4
    assert csv_files.read_text_csv(spark, str(tmp_path / "c"), ["id", "t"]).where("t = 'a\nb'").count() == 1_000
