"""Every registered query: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmill.functions import html as H
from jobmill.functions import location as L
from jobmill.functions import postings as P
from jobmill.functions import salary as M
from jobmill.functions import text as X
from jobmill.functions import tokens as N
from jobmill.operators import audit, enrich, features, frontier, language, load, medians, nlp, pages, rank, streaks
from jobmill.operators.normalize import align
from jobmill.plans import corpus
from jobmill.plans import inputs as I
from jobmill.session import shared_dir
from jobmill.sources import csv_files, lake
from jobmill.sources.tables import postings, table
from jobmill.streaming import enrich as stream_enrich
from jobmill.streaming import export as stream_export
from jobmill.streaming import load as stream_load
from jobmill.streaming import status as stream_states

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def undated(spark: SparkSession, folder: str) -> DataFrame:
    return postings(spark, folder, dates=False)


# --- sources and sinks ---------------------------------------------------------------


@query
def scan_csv_roundtrip(spark, folder):
    columns = ["id", "title", "company", "raw_location", "description"]
    path = shared_dir(spark, "csv")
    csv_files.write_csv(undated(spark, folder).select(*columns), path)
    back = csv_files.read_text_csv(spark, path, columns)
    return back.withColumn("id", F.col("id").try_cast("bigint"))


@query
def report_csv(spark, folder):
    """A report in spreadsheet files, read back; ``marked`` tells whether each file has its byte-order mark."""
    columns = ["id", "site", "company", "career"]
    path = shared_dir(spark, "report")
    csv_files.write_report_csv(undated(spark, folder).select(*columns), path)
    back = csv_files.read_text_csv(spark, path, columns)
    return back.withColumns({"id": F.col("id").try_cast("bigint"), "marked": csv_files.all_marked(spark, path)})


@query
def export_dry_run(spark, folder):
    base = shared_dir(spark, "dry-run")
    rows = lake.run_export(postings(spark, folder), f"{base}/lake", f"{base}/checkpoint", dry_run=True)
    return rows.select("id", "site", I.time_text("date_scraped"))


@query
def restore_types(spark, folder):
    flag = "CASE {} WHEN '{}' THEN 'True' WHEN '{}' THEN 'False' WHEN '{}' THEN 'true' END"
    texts = undated(spark, folder).selectExpr(
        "id",
        "CASE WHEN job_type = 'fulltime' THEN 'n/d' ELSE cast(salary_min AS string) END AS salary_min",
        "CASE WHEN job_type = 'Remoto' THEN 'NaN' ELSE cast(salary_max AS string) END AS salary_max",
        "cast(id AS string) AS n_palabras",
        flag.format("site", "indeed", "occ", "linkedin") + " AS is_premium",
        flag.format("status", "NEW", "APPLIED", "ORPHANED") + " AS tiene_salario",
        flag.format("scraped_by", "worker0", "worker1", "worker2") + " AS es_vacio",
    )
    return csv_files.restore_types(texts)


@query
def export_rows(spark, folder):
    rows = lake.export_rows(postings(spark, folder))
    return rows.withColumn("date_scraped", I.time_text("date_scraped"))


@query
def export_partition_counts(spark, folder):
    return lake.partition_counts(lake.export_rows(postings(spark, folder)))


@query
def export_summary(spark, folder):
    rows = lake.export_rows(postings(spark, folder))
    path = shared_dir(spark, "export")
    lake.write_partitions(rows, path)
    written = lake.read_partitions(spark, path, rows.schema)
    return lake.export_summary(written, len(rows.columns)).withColumn("checkpoint", I.time_text("checkpoint"))


@query
def export_verify_counts(spark, folder):
    rows = lake.export_rows(postings(spark, folder))
    path = shared_dir(spark, "export")
    lake.write_partitions(rows, path)
    return lake.verify(rows, lake.read_partitions(spark, path, rows.schema))


@query
def export_two_runs(spark, folder):
    """Two export runs over a table that grows between them, and what the commits then hold."""
    jobs = postings(spark, folder)
    base = shared_dir(spark, "export-runs")
    early = jobs.where(F.col("date_scraped").isNull() | (F.col("date_scraped") <= I.moment(I.CHECKPOINT)))
    runs = None
    for number, source in enumerate((early, jobs), 1):
        done = lake.run_export(source, f"{base}/lake", f"{base}/checkpoint", run=f"run{number}")
        files_fit = (F.col("files") >= F.col("partitions")).alias("files_fit")
        done = done.select(F.lit(number).alias("run_no"), "records", "columns", "partitions", files_fit, "verified", I.time_text("checkpoint"))
        runs = done if runs is None else runs.unionByName(done)
    held = lake.read_committed(spark, f"{base}/lake", lake.export_rows(jobs).schema)
    return runs.withColumn("committed", F.lit(held.count()).cast("long"))


@query
def incremental_export(spark, folder):
    rows = lake.export_rows(postings(spark, folder), I.moment(I.CHECKPOINT))
    return rows.select("id", "site", "job_url", "status", "has_salary", I.time_text("date_scraped"))


@query
def sample_exact(spark, folder):
    return rank.sample_exact(undated(spark, folder).select("id", "site", "title", "career"), 50)


# --- column rules --------------------------------------------------------------------


@query
def align_schema(spark, folder):
    some = undated(spark, folder).select("id", "site", "job_url", "title", "company", "raw_location", "salary_min", "job_type")
    return align(some)


@query
def job_type_detect(spark, folder):
    return undated(spark, folder).select(
        "id", P.detect_job_type(F.col("title"), F.col("job_type")).alias("modality")
    )


@query
def state_detect(spark, folder):
    return undated(spark, folder).select("id", L.detect_state(F.col("raw_location")).alias("state"))


@query
def salary_from_text(spark, folder):
    found = undated(spark, folder).select("id", M.salary_from_text(F.col("description")).alias("pay"))
    return found.select("id", "pay.salary_min", "pay.salary_max")


@query
def salary_parse(spark, folder):
    found = undated(spark, folder).select("id", M.parse_salary(F.col("description")).alias("pay"))
    return found.select("id", "pay.salary_min", "pay.salary_max")


@query
def salary_first_match(spark, folder):
    return undated(spark, folder).select("id", M.first_amount(F.col("description")).alias("salary_raw"))


@query
def normalize_jobs(spark, folder):
    return I.search_batch(undated(spark, folder))


@query
def map_phase1(spark, folder):
    return I.listing_batch(undated(spark, folder))


@query
def parse_location(spark, folder):
    parsed = undated(spark, folder).select("id", L.parse_location(F.col("raw_location")).alias("place"))
    return parsed.select("id", "place.city", "place.state_code", "place.region")


@query
def salary_flags(spark, folder):
    low, high = F.col("salary_min"), F.col("salary_max")
    return undated(spark, folder).select(
        "id", P.any_salary(low, high).alias("tiene_salario"), P.full_salary(low, high).alias("has_salary")
    )


@query
def title_desc(spark, folder):
    return corpus.add_clean_columns(undated(spark, folder)).select("id", "titulo_desc")


@query
def country_lookup(spark, folder):
    code = F.expr(
        "CASE scraped_by WHEN 'worker0' THEN 'MX' WHEN 'worker1' THEN 'CO' WHEN 'worker2' THEN 'PE' "
        "WHEN 'worker3' THEN 'US' END"
    )
    rows = undated(spark, folder).select("id", code.alias("country_code"))
    code = F.col("country_code")
    return rows.select(
        "id",
        P.country_search_name(code).alias("search_country"),
        P.country_display(code).alias("country"),
        P.country_subdomain(code).alias("subdomain"),
        P.country_currency(code).alias("currency"),
    )


@query
def absolute_url(spark, folder):
    links = table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("base"),
        F.posexplode(H.link_targets(F.col("html"))).alias("pos", "href"),
    )
    return links.select("page_id", "pos", P.absolute_url(F.col("base"), F.col("href")).alias("link"))


@query
def crawl_frontier(spark, folder):
    terms = frontier.distinct_terms(undated(spark, folder), "career")
    return frontier.search_pages(terms, countries=("MX", "CO", "PE", "XX"))


@query
def distinct_terms(spark, folder):
    return frontier.distinct_terms(undated(spark, folder), "career")


# --- text cleaning -------------------------------------------------------------------


@query
def clean_text(spark, folder):
    return undated(spark, folder).select("id", X.clean_description(F.col("description")).alias("clean"))


def _one_step(step):
    def run(spark, folder):
        return undated(spark, folder).select("id", step(F.col("description")).alias("clean"))

    return run


QUERIES["strip_urls"] = _one_step(X.drop_urls)
QUERIES["strip_contacts"] = _one_step(lambda text: X.drop_phones(X.drop_emails(text)))
QUERIES["strip_markdown"] = _one_step(X.drop_markdown)
QUERIES["strip_money"] = _one_step(X.drop_money)


@query
def word_counts(spark, folder):
    return corpus.add_clean_columns(undated(spark, folder)).select("id", "n_palabras", "es_vacio")


@query
def lang_profile(spark, folder):
    return language.profile(table(spark, folder, "documents"), "text", "lang")


@query
def lang_open_set(spark, folder):
    """Every document's language by a model that never saw French: a label, or ``otro`` for none of them."""
    docs = table(spark, folder, "documents")
    model = language.train_open(docs.where("lang <> 'fr'"), "text", "lang")
    found = F.coalesce(model.language(F.col("text")), F.lit(language.OTHER))
    return docs.select("doc_id", "lang", found.alias("detected"))


@query
def lang_detect(spark, folder):
    model = language.train(table(spark, folder, "documents"), "text", "lang")
    cleaned = corpus.add_clean_columns(undated(spark, folder))
    return language.detect(cleaned, "descripcion_limpia", ~F.col("es_vacio"), model).select("id", "idioma_det")


# --- corpora -------------------------------------------------------------------------


@query
def cleaned_corpus(spark, folder):
    model = language.train(table(spark, folder, "documents"), "text", "lang")
    rows = corpus.cleaned_corpus(postings(spark, folder), model)
    return rows.withColumn("date_scraped", I.time_text("date_scraped"))


@query
def nlp_corpus(spark, folder):
    return I.nlp_rows(spark, folder).select(
        "id", "idioma_det", "descripcion_nlp", "titulo_nlp", "texto_nlp", "n_palabras_nlp", "es_vacio_nlp"
    )


# --- tokens --------------------------------------------------------------------------


def _tokens(spark, folder, rule):
    rows = I.labelled_corpus(spark, folder).select("id", "descripcion_limpia", "idioma_det")
    tokens = rows.withColumn("tokens", rule(F.col("descripcion_limpia"), F.col("idioma_det")))
    return tokens.select("id", F.size("tokens").alias("n_tokens"), N.joined(F.col("tokens")).alias("tokens"))


@query
def tokenize(spark, folder):
    return _tokens(spark, folder, lambda text, lang: N.tokenize(text))


@query
def stopword_filter(spark, folder):
    return _tokens(spark, folder, lambda text, lang: N.without_stop_words(N.tokenize(text), lang))


@query
def token_filter(spark, folder):
    return _tokens(spark, folder, lambda text, lang: N.without_short_or_numeric(N.tokenize(text)))


@query
def lemmatize(spark, folder):
    rows = I.labelled_corpus(spark, folder)
    tokens = rows.select(
        "id", "idioma_det", nlp.content_tokens(F.col("descripcion_limpia"), F.col("idioma_det")).alias("tokens")
    )
    tokens = nlp.stored(tokens, "tokens")
    done = nlp.lemmatize(tokens, "tokens", "idioma_det", I.plural_lemmas(tokens, "tokens"))
    done = nlp.stored(done, "lemma-rows")
    return done.select("id", N.joined(F.col("tokens")).alias("lemmas"))


@query
def nlp_text(spark, folder):
    return I.nlp_rows(spark, folder).select("id", "descripcion_nlp")


@query
def nlp_title(spark, folder):
    return I.nlp_rows(spark, folder).select("id", "titulo_nlp")


@query
def nlp_combined(spark, folder):
    return I.nlp_rows(spark, folder).select("id", "texto_nlp")


@query
def nlp_flags(spark, folder):
    return I.nlp_rows(spark, folder).select("id", "n_palabras_nlp", "es_vacio_nlp")


# --- filters -------------------------------------------------------------------------


@query
def enrichment_queue(spark, folder):
    return enrich.queue(undated(spark, folder)).select("id", "site", "job_url")


@query
def enrichment_batches(spark, folder):
    return enrich.batches(undated(spark, folder)).select("id", "site", "batch_no", "batch_count")


@query
def recent_72h(spark, folder):
    rows = table(spark, folder, "events")
    now = rows.agg(F.max("ts")).scalar()
    return rows.where(P.is_recent(F.col("ts"), now)).select("event_id", I.time_text("ts"))


@query
def monday_source_rule(spark, folder):
    jobs = postings(spark, folder)
    allowed = (F.col("site") != "linkedin") | P.is_source_day(F.col("date_scraped"))
    return jobs.where(allowed).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query
def enabled_sources(spark, folder):
    # The switch of each source.
    flags = spark.createDataFrame(
        [("indeed", True), ("linkedin", False), ("computrabajo", True), ("occ", False)], "source string, enabled boolean"
    )
    return frontier.enabled_sources(undated(spark, folder).select("id", "site"), flags).select("id", "site")


# --- load and update -----------------------------------------------------------------


@query
def dedup_first(spark, folder):
    return load.dedup_first(undated(spark, folder).select("id", "job_url", "site", "title"), "job_url", ["id"])


@query
def insert_new_only(spark, folder):
    jobs = undated(spark, folder)
    new = load.new_rows(I.stored_links(jobs), I.search_batch(jobs), ["id"])
    return new.select("id", "job_url", "title", "company", "status")


@query
def load_counts(spark, folder):
    jobs = undated(spark, folder)
    return load.load_counts(I.stored_links(jobs), I.listing_batch(jobs), ["id"])


@query
def load_by_source(spark, folder):
    jobs = undated(spark, folder)
    batches = [
        ("jobspy", I.search_batch(jobs.where(F.col("site").isin(*I.SEARCH_SITES)))),
        *[(site, I.listing_batch(jobs.where(F.col("site") == site))) for site in I.LISTING_SITES],
    ]
    everything = load.cascade(batches).withColumn("term_order", load.term_rank(F.col("career"), I.TERMS))
    order = ["term_order", "load_order", "id"]
    return load.load_counts(I.stored_links(jobs), everything, order, "load_source")


@query
def mark_notified(spark, folder):
    return load.mark_notified(undated(spark, folder)).select("id", "status")


@query
def mark_applied(spark, folder):
    jobs = postings(spark, folder)
    chosen = jobs.where("status = 'NEW' AND salary_min IS NOT NULL").select("id")
    done = load.mark_applied(jobs, chosen, I.moment(I.TODAY))
    return done.select("id", "status", I.time_text("applied_date"))


@query
def enrich_merge(spark, folder):
    jobs = undated(spark, folder)
    listing = jobs.where(F.col("job_url").isNotNull()).select("id", "job_url", "salary_min", "salary_max")
    return enrich.merge_details(listing, I.visit_results(jobs), "id")


@query
def enrich_update(spark, folder):
    after = enrich.apply_updates(postings(spark, folder), I.visit_results(undated(spark, folder)), I.moment(I.TODAY))
    return after.select("id", "description", "salary_min", "salary_max", "status", I.time_text("last_updated"))


@query
def enrichment_summary(spark, folder):
    jobs = undated(spark, folder)
    return enrich.run_totals(jobs, I.visit_results(jobs))


@query
def failure_streaks(spark, folder):
    outcome = "CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'empty' ELSE 'ok' END AS outcome"
    rows = table(spark, folder, "events").selectExpr("user_id", "ts", "event_id", outcome)
    trips = streaks.failure_trips(rows, "user_id", "ts", "event_id", "outcome")
    return trips.select("user_id", "event_id", "run_length")


# --- audit and reports ---------------------------------------------------------------


@query
def audit_summary(spark, folder):
    return audit.summary(undated(spark, folder))


@query
def audit_duplicates(spark, folder):
    return audit.duplicate_links(undated(spark, folder))


@query
def audit_constraints(spark, folder):
    return audit.constraint_violations(undated(spark, folder))


@query
def top_regions(spark, folder):
    place = L.parse_location(F.col("raw_location"))
    return audit.top_regions(undated(spark, folder).select(place["region"].alias("region")))


@query
def corpus_summary(spark, folder):
    return audit.corpus_summary(corpus.add_clean_columns(undated(spark, folder)))


@query
def median_words_by_career(spark, folder):
    rows = corpus.add_clean_columns(undated(spark, folder))
    return audit.median_by(rows, "career", "n_palabras", "es_vacio")


@query
def median_words_by_day(spark, folder):
    """Medians per career from sketches of days, stored in two runs; the exact rank of each is checked."""
    cleaned = corpus.add_clean_columns(postings(spark, folder)).where(~F.col("es_vacio"))
    rows = nlp.stored(cleaned.select("career", "n_palabras", "date_scraped"), "words")
    path, day = shared_dir(spark, "day-sketches"), F.col("date_scraped").cast("date")
    early = F.coalesce(day < I.moment(I.CHECKPOINT).cast("date"), F.lit(False))
    for run in (early, ~early):
        medians.store_days(medians.sketches(rows.where(run), "career", "n_palabras", day), path)
    found = medians.medians(medians.read_days(spark, path))
    checked = medians.checked(rows, "career", "n_palabras", found)
    return checked.select(F.col("grp").alias("career"), "n", "exact_rank_fits")


@query
def language_dist(spark, folder):
    model = language.train(table(spark, folder, "documents"), "text", "lang")
    cleaned = corpus.add_clean_columns(undated(spark, folder))
    found = language.detect(cleaned, "descripcion_limpia", ~F.col("es_vacio"), model)
    return audit.language_shares(found, "idioma_det", "es_vacio")


@query
def nlp_summary(spark, folder):
    return audit.nlp_summary(I.nlp_rows(spark, folder))


@query
def nlp_language_dist(spark, folder):
    return audit.language_shares(I.nlp_rows(spark, folder), "idioma_det", "es_vacio_nlp")


@query
def median_tokens_by_career(spark, folder):
    return audit.median_by(I.nlp_rows(spark, folder, "career"), "career", "n_palabras_nlp", "es_vacio_nlp")


@query
def before_after_sample(spark, folder):
    return rank.before_after(I.nlp_rows(spark, folder, "career", "city", "descripcion_limpia"))


@query
def followup_score(spark, folder):
    return rank.followup_scores(postings(spark, folder), I.moment(I.TODAY))


@query
def new_jobs_top20(spark, folder):
    return rank.new_postings(postings(spark, folder)).withColumn("date_scraped", I.time_text("date_scraped"))


@query
def report_open_jobs(spark, folder):
    rows = rank.open_postings(postings(spark, folder))
    return rows.withColumn("local_date_scraped", I.time_text("local_date_scraped"))


@query
def report_cards(spark, folder):
    rows = rank.report_cards(postings(spark, folder))
    return rows.withColumn("local_date_scraped", I.time_text("local_date_scraped"))


@query
def cap_results(spark, folder):
    rows = undated(spark, folder).select("id", "career", "site")
    return rank.cap_per_group(rows, ["career"], ["site", "id"], 25)


@query
def pagination_cutoff(spark, folder):
    rows = table(spark, folder, "events").selectExpr(
        "user_id", "event_id AS page", "event_type = 'error' AS is_empty", "event_type <> 'signup' AS has_next"
    )
    return rank.until_pagination_stops(rows, "user_id", "page", "is_empty", "has_next", "page")


# --- pages ---------------------------------------------------------------------------

# Markup of the stored test pages.
PAGE_PROFILE = pages.Profile(
    site="pages",
    card="nav li",
    fields={"title": pages.Field("a"), "href": pages.Field("a", attr="href")},
    details=("#Descripcion", "article"),
)


@query
def extract_cards(spark, folder):
    cards = pages.page_cards(table(spark, folder, "pages"), "page_id", PAGE_PROFILE)
    return pages.listing_rows(cards, PAGE_PROFILE).select("page_id", "card_no", "title", "job_url")


@query
def site_cards(spark, folder):
    """Listing rows of both sites' cards, one page per document, marked up as the sites do."""
    docs = {"documents": table(spark, folder, "documents")}
    out = []
    for profile, markup in ((pages.COMPUTRABAJO, I.COMPUTRABAJO_CARDS_SQL), (pages.OCC, I.OCC_CARDS_SQL)):
        made = spark.sql(f"SELECT doc_id AS page_id, {markup} AS html FROM {{documents}}", **docs)
        rows = pages.listing_rows(pages.page_cards(made, "page_id", profile), profile)
        out.append(rows.drop("description", "currency", "country_code"))
    return out[0].unionByName(out[1])


@query
def extract_detail(spark, folder):
    return pages.page_details(table(spark, folder, "pages"), "page_id", PAGE_PROFILE)


@query
def page_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", H.visible_text(F.col("html")).alias("page_text"))


@query
def page_fields(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id",
        H.inner_text(html, "title").alias("title"),
        H.inner_text(html, "h1").alias("heading"),
        F.array_join(H.link_targets(html), " ").alias("links"),
    )


# --- term statistics and models ------------------------------------------------------


def _usable_tokens(rows):
    return rows.where("NOT es_vacio_nlp").select("id", F.split("descripcion_nlp", " ").alias("tokens"))


def _token_rows(spark, folder):
    """Tokens of the usable rows, stored: term statistics read them more than once."""
    return nlp.stored(_usable_tokens(nlp.nlp_columns(I.lemma_rows(spark, folder))), "token-rows")


@query
def term_frequencies(spark, folder):
    return features.term_counts(_usable_tokens(I.nlp_rows(spark, folder)), "tokens")


@query
def bow_top_terms(spark, folder):
    return features.top_terms(term_frequencies(spark, folder), 3000)


@query
def ngram_counts(spark, folder):
    return features.term_counts(_token_rows(spark, folder), "tokens", 2, 3)


@query
def tfidf_top_terms(spark, folder):
    return features.tfidf_top(_token_rows(spark, folder), "tokens")


@query
def tfidf_matrix(spark, folder):
    return features.tfidf_matrix(_token_rows(spark, folder), "id", "tokens")


@query
def lda_topics(spark, folder):
    return features.lda_topics(_token_rows(spark, folder), "tokens")


@query
def kmeans_cosine(spark, folder):
    return features.cosine_clusters(table(spark, folder, "embeddings"), "vec_id", "embedding")


# --- streams -------------------------------------------------------------------------


def _drops(rows: DataFrame, path: str) -> None:
    """The rows as two file drops, one per group of sites."""
    first = F.col("site").isin(*I.SEARCH_SITES)
    rows.where(first).write.mode("append").parquet(path)
    rows.where(~first).write.mode("append").parquet(path)


@query
def stream_export_rows(spark, folder):
    rows = postings(spark, folder)
    base = shared_dir(spark, "stream-export")
    _drops(rows, f"{base}/in")
    drops = stream_export.read_drops(spark, f"{base}/in", rows.schema, files_per_batch=1)
    stream_export.start_export(drops, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    written = lake.read_partitions(spark, f"{base}/out", lake.export_rows(rows).schema)
    return written.select("id", "site", "status", "has_salary", lake.PARTITION)


@query
def stream_insert_new(spark, folder):
    rows = undated(spark, folder)
    base = shared_dir(spark, "stream-insert")
    # The second drop repeats links of the first, so its batches meet what is stored already. A drop
    # has as many files as its tasks write; each comes in a run that goes on from the checkpoint.
    batch, repeats = I.search_batch(rows), F.col("id") % 10 == 9
    for part, seed in ((~repeats, I.stored_links(rows)), (repeats, None)):
        batch.where(part).write.mode("append").parquet(f"{base}/in")
        drops = stream_export.read_drops(spark, f"{base}/in", batch.schema)
        stream_load.start_insert(drops, f"{base}/table", f"{base}/checkpoint", ["id"], seed=seed).awaitTermination()
    return stream_load.read_table(spark, f"{base}/table", batch.schema).select("id", "job_url", "title", "company", "status")


@query
def stream_first_within(spark, folder):
    """Events in three drops by time, each with all events of the drop before once more: every event comes once."""
    events = table(spark, folder, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    base = shared_dir(spark, "stream-within")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    third = [low + (high - low) * i / 3 for i in range(3)] + [high]
    parts = [events.where((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(third[:-2], third[1:-1], strict=True)]
    parts.append(events.where(F.col("ts") >= third[2]))
    for i, part in enumerate(parts):
        drop = part if i == 0 else part.unionByName(parts[i - 1])
        drop.coalesce(1).write.mode("append").parquet(f"{base}/in")
    drops = stream_export.read_drops(spark, f"{base}/in", events.schema, files_per_batch=1)
    stream_load.start_first_within(drops, f"{base}/out", f"{base}/checkpoint", "ts", "1 day", "event_id").awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{base}/out").select("event_id", "event_type")


@query
def stream_enrich_update(spark, folder):
    jobs = postings(spark, folder)
    base = shared_dir(spark, "stream-enrich")
    results = I.visit_results(undated(spark, folder)).withColumn("visited_at", I.moment(I.TODAY))
    results.write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    drops = stream_export.read_drops(spark, f"{base}/in", schema, files_per_batch=1)
    stream_enrich.start_log(drops, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    after = stream_enrich.current_table(jobs, f"{base}/log", I.moment(I.TODAY))
    return after.select("id", "description", "salary_min", "salary_max", "status", I.time_text("last_updated"))


@query
def stream_status(spark, folder):
    """Later visits of every link come a drop before the first one, and both come again in a third drop."""
    base = shared_dir(spark, "stream-status")
    first = I.visit_results(undated(spark, folder)).withColumn("visited_at", I.moment(I.TODAY))
    later = first.select(
        "job_url",
        F.when(F.col("description").isNull(), F.lit("Otro detalle")).alias("description"),
        F.lit("$1,000").alias("salary_raw"),
        (F.col("visited_at") + F.expr("INTERVAL 1 HOUR")).alias("visited_at"),
    )
    # A drop has as many files as its tasks write; each comes in a run that goes on from the checkpoint.
    for drop in (later, first, first.unionByName(later)):
        drop.write.mode("append").parquet(f"{base}/in")
        drops = stream_export.read_drops(spark, f"{base}/in", drop.schema)
        stream_states.start(drops, f"{base}/log", f"{base}/checkpoint", "2 hours").awaitTermination()
    after = stream_states.current_table(postings(spark, folder), f"{base}/log", I.moment(I.TODAY))
    return after.select("id", "description", "salary_min", "salary_max", "status", I.time_text("last_updated"))
