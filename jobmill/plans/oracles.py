"""The registered queries once more as SQL for DuckDB, to check results against."""

from __future__ import annotations

from jobmill import lookups
from jobmill.functions.text import BLANKS
from jobmill.operators.language import LANGUAGES, LETTERS
from jobmill.plans.inputs import CHECKPOINT, TODAY
from jobmill.sources.csv_files import NA_WORDS
from jobmill.sources.tables import postings_sql

JOBS = f"WITH jobs AS ({postings_sql()})"
SP, NSP = r"[\s\x{0B}\x{85}\p{Z}]", r"[^\s\x{0B}\x{85}\p{Z}]"
TIME = "'%Y-%m-%d %H:%M:%S.%f'"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(values) -> str:
    return ", ".join(q(v) for v in values)


def sub(expr: str, pattern: str, put: str = "") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(put)}, 'g')"


def strip(expr: str) -> str:
    return f"trim({expr}, {q(BLANKS)})"


def unescape(x: str) -> str:
    x = f"replace(replace(replace({x}, '\\n', chr(10)), '\\t', ' '), '\\r', '')"
    return sub(x, r"\\([.\-*\[\]()\\])", r"\1")


def drop_urls(x: str) -> str:
    return sub(x, rf"https?://{NSP}+|www\.{NSP}+", " ")


def drop_contacts(x: str) -> str:
    x = sub(x, rf"{NSP}+@{NSP}+\.{NSP}+", " ")
    return sub(x, rf"\b\p{{Nd}}{{10,}}\b|\(\p{{Nd}}{{2,3}}\){SP}*\p{{Nd}}{{3,4}}(?:-|{SP})\p{{Nd}}{{4}}", " ")


def drop_markdown(x: str) -> str:
    x = sub(sub(x, r"\*\*(.+?)\*\*", r"\1"), r"\*(.+?)\*", r"\1")
    return sub(sub(x, rf"(?m)^{SP}*[*\-•·]{SP}*"), r"#[\p{L}\p{N}_]+", " ")


def drop_money(x: str) -> str:
    return sub(x, rf"(?i)\$[\p{{Nd}},.]+|[\p{{Nd}},.]+{SP}*(MXN|USD|pesos?|dólares?)", " ")


def clean(x: str) -> str:
    x = drop_money(drop_markdown(drop_contacts(drop_urls(unescape(x)))))
    return f"coalesce({strip(sub(sub(x, '[ \t]{2,}', ' '), chr(10) + '{3,}', chr(10) * 2))}, '')"


def count_words(x: str) -> str:
    return f"coalesce(len(list_filter(regexp_split_to_array({x}, {q(SP + '+')}), lambda w: w <> '')), 0)"


def tokens(x: str) -> str:
    bare = sub(f"lower({x})", r"[^\p{L}\p{N}_\s\x{0B}\x{85}\p{Z}\-]", " ")
    return f"list_filter(regexp_split_to_array(coalesce({bare}, ''), {q(SP + '+')}), lambda w: w <> '')"


def without_stops(x: str, lang: str) -> str:
    def kept(code: str) -> str:
        return f"list_filter({x}, lambda w: w NOT IN ({words(lookups.stop_words(code))}))"

    return f"CASE {lang} WHEN 'es' THEN {kept('es')} WHEN 'en' THEN {kept('en')} ELSE {kept('otro')} END"


def long_words(x: str) -> str:
    return f"list_filter({x}, lambda w: length(w) > 2 AND NOT regexp_full_match(w, '\\p{{Nd}}+'))"


def amounts(pattern: str) -> str:
    found = f"regexp_extract_all(description, {q(pattern)}, 1)"
    return f"list_transform({found}, lambda m: try_cast(replace(m, ',', '') AS DOUBLE))"


def shifted(expr: str) -> str:
    return f"strftime({expr} - INTERVAL 6 HOUR, {TIME})"


def pct(part: str, whole: str) -> str:
    return f"coalesce(round(100.0 * {part} / nullif({whole}, 0), 6), 0.0)"


JOB_TYPE = """CASE WHEN contains(t, 'remote') OR contains(t, 'remoto') OR contains(t, 'home office') THEN 'remoto'
  WHEN contains(t, 'hybrid') OR contains(t, 'hibrido') OR contains(t, 'híbrido') THEN 'hibrido' ELSE 'presencial' END"""
UPPER_TITLE = "upper(replace(coalesce(title, ''), 'ß', 'ss'))"
THOUSANDS = r"\$" + SP + r"?([0-9]{1,3}(?:,[0-9]{3})+)"
ANY_AMOUNT = r"\$?" + SP + r"*([0-9,]+\.?[0-9]*)"
FIRST_AMOUNT = (
    r"\$" + SP + r"*[0-9,]+\.?[0-9]*(?:" + SP + r"*[-–]" + SP + r"*\$?" + SP + r"*[0-9,]+\.?[0-9]*)?"
)


def state(location: str) -> str:
    tests = " ".join(f"WHEN contains(lower({location}), {q(w)}) THEN {q(s)}" for w, s in lookups.STATE_WORDS)
    return f"CASE {tests} END"


def region_sql() -> str:
    known = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in lookups.REGIONS.items())
    city = " OR ".join(f"contains(lower(city), {q(c)})" for c in lookups.BAJIO_CITIES)
    place = rf"^(.+?),{SP}*([A-Z]{{2,3}}),{SP}*([A-Z]{{2}})$"
    remote = r"(?i)(^|[^\p{L}\p{N}_])(desde casa|remoto|remote)($|[^\p{L}\p{N}_])"
    return f"""
    places AS (SELECT *, CASE code WHEN '' THEN NULL {known} END AS known FROM (
      SELECT *, {strip(f"regexp_extract(raw, {q(place)}, 1)")} AS city, regexp_extract(raw, {q(place)}, 2) AS code,
        regexp_extract(raw, {q(place)}, 3) AS nation
      FROM (SELECT *, {strip("raw_location")} AS raw FROM jobs))),
    located AS (SELECT * EXCLUDE (city),
      CASE WHEN raw IS NULL OR raw = '' THEN NULL WHEN regexp_matches(raw, {q(remote)}) THEN 'Remoto'
        WHEN code <> '' THEN city ELSE raw END AS city,
      CASE WHEN raw IS NULL OR raw = '' OR regexp_matches(raw, {q(remote)}) OR code = '' THEN NULL ELSE code END AS state_code,
      CASE WHEN raw IS NULL OR raw = '' THEN 'Sin dato' WHEN regexp_matches(raw, {q(remote)}) THEN 'Remoto'
        WHEN code = '' THEN 'Sin dato' WHEN nation <> 'MX' THEN 'Internacional'
        WHEN known = 'Bajío' AND ({city}) THEN 'Bajío — ' || city ELSE coalesce(known, code) END AS region
      FROM places)"""


CLEANED = f"""{JOBS}, cleaned AS (SELECT *, {clean("description")} AS descripcion_limpia FROM jobs),
corpus AS (SELECT *, n_palabras < 15 AS es_vacio, CASE WHEN lang IN ('es', 'en') THEN lang ELSE 'otro' END AS idioma
  FROM (SELECT *, {count_words("descripcion_limpia")} AS n_palabras FROM cleaned))"""
PROFILE = f"""profile AS (
  SELECT gram, {", ".join(f"cast(sum(CASE WHEN lang = {q(c)} THEN n ELSE 0 END) AS BIGINT) AS n_{c}" for c in LANGUAGES)}
  FROM (SELECT lang, n, unnest(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3))) AS gram
    FROM (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(string_split(trim({sub("lower(text)", f"[^{LETTERS}]+", " ")}), ' ')) AS w
      FROM documents WHERE lang IN ({words(LANGUAGES)})) WHERE w <> '' GROUP BY lang, w)) GROUP BY gram)"""
SCORES = ", ".join(
    f"sum(c * ln((n_{c} + 1.0) / ((SELECT sum(n_{c}) FROM profile) + (SELECT count(*) FROM profile)))) AS p_{c}"
    for c in LANGUAGES
)
BEST = " ".join(f"WHEN p_{c} = greatest({', '.join(f'p_{x}' for x in LANGUAGES)}) THEN {q(c)}" for c in LANGUAGES)
DETECTED = f"""{CLEANED}, {PROFILE}, words AS (
  SELECT id, w, count(*) AS k FROM (
    SELECT id, unnest(string_split(trim({sub("lower(descripcion_limpia)", f"[^{LETTERS}]+", " ")}), ' ')) AS w
    FROM corpus WHERE NOT es_vacio AND length(descripcion_limpia) >= 20) WHERE w <> '' GROUP BY id, w),
grams AS (SELECT id, gram, sum(k) AS c FROM (
    SELECT id, k, unnest(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3))) AS gram FROM words)
  GROUP BY id, gram),
scored AS (SELECT id, {SCORES.replace("sum(c *", "sum(grams.c *")} FROM grams JOIN profile USING (gram) GROUP BY id),
found AS (SELECT id, CASE {BEST} END AS language FROM scored),
detected AS (SELECT corpus.*, CASE WHEN language IN ('es', 'en') THEN language ELSE 'otro' END AS idioma_det
  FROM corpus LEFT JOIN found USING (id))"""
CONTENT = long_words(without_stops(tokens("descripcion_limpia"), "idioma"))
TEXT_CONTENT = long_words(without_stops(tokens("descripcion_limpia"), "idioma_det"))
TITLE_CONTENT = long_words(without_stops(tokens("title"), "idioma_det"))
# The token corpus in full: detected language, stop words, lemmas learned from the corpus.
NLP = f"""{DETECTED}, content AS (SELECT *, CASE WHEN idioma_det = 'en' THEN 'en' ELSE 'es' END AS ll,
    CASE WHEN es_vacio THEN [] ELSE {TEXT_CONTENT} END AS raw_toks, {TITLE_CONTENT} AS raw_title FROM detected),
vocabulary AS (SELECT DISTINCT ll, unnest(list_concat(raw_title, raw_toks)) AS token FROM content),
lemmas AS (SELECT p.ll, p.token, s.token AS lemma FROM vocabulary p JOIN vocabulary s ON s.ll = p.ll AND p.token = s.token || 's'),
placed AS (
  SELECT id, ll, 'text' AS part, unnest(raw_toks) AS token, unnest(range(len(raw_toks))) AS pos FROM content
  UNION ALL SELECT id, ll, 'title', unnest(raw_title), unnest(range(len(raw_title))) FROM content),
rebuilt AS (SELECT id, list(coalesce(lemma, w.token) ORDER BY pos) FILTER (part = 'text') AS toks,
    list(coalesce(lemma, w.token) ORDER BY pos) FILTER (part = 'title') AS title_toks
  FROM placed w LEFT JOIN lemmas ON lemmas.ll = w.ll AND lemmas.token = w.token GROUP BY id),
nlp AS (SELECT *, es_vacio OR n_palabras_nlp < 5 AS es_vacio_nlp FROM (
  SELECT content.*, coalesce(toks, []) AS toks, len(coalesce(toks, [])) AS n_palabras_nlp,
    array_to_string(coalesce(toks, []), ' ') AS descripcion_nlp, array_to_string(coalesce(title_toks, []), ' ') AS titulo_nlp
  FROM content LEFT JOIN rebuilt USING (id)))"""
LEMMAS = f"""{CLEANED}, content AS (SELECT id, es_vacio, CASE WHEN idioma = 'en' THEN 'en' ELSE 'es' END AS ll, {CONTENT} AS toks FROM corpus),
vocabulary AS (SELECT DISTINCT ll, unnest(toks) AS token FROM content),
lemmas AS (SELECT p.ll, p.token, s.token AS lemma FROM vocabulary p JOIN vocabulary s
  ON s.ll = p.ll AND p.token = s.token || 's'),
rebuilt AS (SELECT id, string_agg(coalesce(lemma, w.token), ' ' ORDER BY pos) AS lemmas
  FROM (SELECT id, ll, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM content) w
  LEFT JOIN lemmas ON lemmas.ll = w.ll AND lemmas.token = w.token GROUP BY id)"""
VISITS = """visits AS (SELECT job_url,
  max_by(CASE WHEN id % 3 <> 0 THEN 'Detalle ' || cast(id AS VARCHAR) ELSE chr(1) END, id) AS d,
  max_by(CASE id % 4 WHEN 0 THEN '$12,000 - $15,000' WHEN 1 THEN 'A convenir' WHEN 2 THEN '$20,000.50' ELSE chr(1) END, id) AS s
  FROM jobs WHERE job_url IS NOT NULL GROUP BY job_url),
results AS (SELECT job_url, nullif(d, chr(1)) AS found,
  CASE s WHEN '$12,000 - $15,000' THEN 12000.0 WHEN '$20,000.50' THEN 20000.5 END AS low,
  CASE s WHEN '$12,000 - $15,000' THEN 15000.0 WHEN '$20,000.50' THEN 20000.5 END AS high FROM visits)"""
STORED = """stored AS (SELECT DISTINCT job_url FROM jobs
  WHERE status NOT IN ('NEW', 'PENDING_ENRICHMENT') AND job_url IS NOT NULL)"""
SEARCH_ROWS = f"""SELECT id, coalesce(site, 'unknown') AS site, job_url, {UPPER_TITLE} AS title,
  coalesce(company, 'Empresa confidencial') AS company, coalesce(raw_location, 'Ubicación desconocida') AS raw_location,
  'México' AS country, cast(NULL AS VARCHAR) AS country_code, {state("raw_location")} AS state, career, scraped_by,
  industry_niche, false AS is_premium,
  (SELECT {JOB_TYPE} FROM (SELECT lower(coalesce(title, '') || ' ' || coalesce(raw_location, 'Ubicación desconocida')) AS t)) AS job_type,
  CASE WHEN salary_min IS NULL AND salary_max IS NULL THEN list_min({amounts(THOUSANDS)}) ELSE salary_min END AS salary_min,
  CASE WHEN salary_min IS NULL AND salary_max IS NULL THEN list_max({amounts(THOUSANDS)}) ELSE salary_max END AS salary_max,
  coalesce(currency, 'MXN') AS currency, description, date_posted, 'NEW' AS status
  FROM jobs WHERE coalesce(job_url, '') <> ''"""
UPDATED = f"""{JOBS}, {VISITS}, updated AS (SELECT j.*,
  r.job_url IS NOT NULL AND site IN ('computrabajo', 'occ') AND status = 'PENDING_ENRICHMENT' AS visited,
  found, low, high FROM jobs j LEFT JOIN results r USING (job_url))"""
UPDATED_ROWS = f"""{UPDATED} SELECT id,
  CASE WHEN visited AND found IS NOT NULL THEN found ELSE description END AS description,
  CASE WHEN visited AND found IS NOT NULL AND salary_min IS NULL AND low IS NOT NULL THEN low ELSE salary_min END AS salary_min,
  CASE WHEN visited AND found IS NOT NULL AND salary_min IS NULL AND low IS NOT NULL THEN high ELSE salary_max END AS salary_max,
  CASE WHEN visited AND found IS NOT NULL THEN 'NEW' WHEN visited THEN 'ORPHANED' ELSE status END AS status,
  strftime(CASE WHEN visited THEN TIMESTAMP '{TODAY}' ELSE last_updated END, {TIME}) AS last_updated FROM updated"""
EXPORT = f"{JOBS}, exported AS (SELECT * FROM jobs WHERE status IN ('NEW', 'PENDING_ENRICHMENT'))"
DAY = "coalesce(strftime(date_scraped, '%Y-%m-%d'), 'unknown')"
HAS_SALARY = "salary_min IS NOT NULL AND salary_max IS NOT NULL AS has_salary"


def printable(x: str) -> str:
    return f"regexp_replace(translate(coalesce({x}, ''), '“”’–', '\"\"''-'), '[^\\x00-\\xff]', '?', 'g')"


def filled(x: str, fallback: str) -> str:
    return f"CASE WHEN coalesce({x}, '') = '' THEN {q(fallback)} ELSE {printable(x)} END"


def visible(x: str) -> str:
    x = sub(x, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "\x01")
    x = sub(x, r"(?s)</?[A-Za-z!?][^>]*>", "\x01")
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("nbsp", "\xa0"), ("copy", "©"),
                       ("middot", "·"), ("amp", "&")):
        x = sub(x, rf"&{name}(?:;|\b)", char)
    return x


def text_of(x: str, put: str) -> str:
    return strip(sub(visible(x), rf"{SP}*\x01(?:{SP}|\x01)*", put))


def counted_terms(low: int, high: int) -> str:
    runs = " UNION ALL ".join(
        f"SELECT id, unnest(list_transform(range(1, len(toks) - {n - 2}), lambda i: array_to_string(toks[i:i + {n - 1}], ' '))) AS term FROM token_rows"
        for n in range(low, high + 1)
    )
    rows = "token_rows AS (SELECT id, toks FROM nlp WHERE NOT es_vacio_nlp)"
    return f"""{NLP}, {rows}, terms AS ({runs}),
    per_text AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term),
    counts AS (SELECT term, cast(sum(tf) AS BIGINT) AS n, count(*) AS n_docs FROM per_text GROUP BY term)"""


def shares(source: str, language: str, unusable: str) -> str:
    return f"""SELECT {language} AS idioma, count(*) AS n,
    {pct("count(*)", f"(SELECT count(*) FROM {source} WHERE NOT {unusable})")} AS pct
    FROM {source} WHERE NOT {unusable} GROUP BY 1"""


def loads(rows: str, by: str, order: str) -> str:
    """Inserted, skipped and rejected rows of ``rows(job_url, ...)``."""
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""{JOBS}, {STORED}, incoming AS ({rows}),
    ranked AS (SELECT *, CASE WHEN job_url IS NOT NULL
      AND row_number() OVER (PARTITION BY job_url ORDER BY {order}) = 1
      AND job_url NOT IN (SELECT job_url FROM stored) THEN 1 ELSE 0 END AS won FROM incoming)
    SELECT {key}cast(sum(won) AS BIGINT) AS inserted,
      cast(count(job_url) - sum(won) AS BIGINT) AS skipped, count(*) - count(job_url) AS rejected FROM ranked {group}"""


TFIDF = f"""{counted_terms(1, 3)}, kept AS (SELECT *, ln(((SELECT count(*) FROM token_rows) + 1.0) / (n_docs + 1.0)) + 1.0 AS idf
    FROM (SELECT * FROM counts ORDER BY n DESC, term LIMIT 5000)),
  weighted AS (SELECT id, term, n, n_docs, tf * idf AS w FROM per_text JOIN kept USING (term)),
  norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY id)"""
NA_CASE = "CASE WHEN {0} NOT IN (" + words(NA_WORDS) + ") THEN {0} END AS {0}"
DEFAULTED = f"""coalesce(company, 'Empresa confidencial') AS company,
  coalesce(raw_location, 'Ubicación desconocida') AS raw_location"""
CHECKS = [
    *[(c, "too_long", f"length({c}) > {cap}") for c, cap in (
        ("site", 50), ("country", 50), ("country_code", 5), ("career", 100), ("scraped_by", 50),
        ("industry_niche", 50), ("job_type", 20), ("currency", 10), ("status", 20))],
    *[(c, "missing", f"{c} IS NULL") for c in ("job_url", "title", "company", "raw_location")],
]

ORACLES: dict[str, str] = {
    "scan_csv_roundtrip": f"{JOBS} SELECT id, "
    + ", ".join(NA_CASE.format(c) for c in ("title", "company", "raw_location", "description"))
    + " FROM jobs",
    "report_csv": f"{JOBS} SELECT id, site, company, career, true AS marked FROM jobs",
    "export_dry_run": f"""{EXPORT} SELECT id, site, strftime(date_scraped, {TIME}) AS date_scraped FROM exported
      ORDER BY exported.date_scraped DESC NULLS LAST, id LIMIT 3""",
    "restore_types": f"""{JOBS} SELECT id,
      CASE WHEN job_type = 'fulltime' THEN NULL ELSE salary_min END AS salary_min,
      CASE WHEN job_type = 'Remoto' THEN NULL ELSE salary_max END AS salary_max,
      cast(id AS DOUBLE) AS n_palabras, site = 'indeed' AS is_premium, status = 'NEW' AS tiene_salario,
      scraped_by <> 'worker1' AS es_vacio FROM jobs""",
    "export_rows": f"""{EXPORT} SELECT id, site, job_url, title, company, raw_location, country, country_code, career,
      scraped_by, industry_niche, job_type, salary_min, salary_max, currency, description, date_posted,
      strftime(date_scraped, {TIME}) AS date_scraped, status, {HAS_SALARY} FROM exported""",
    "export_partition_counts": f"{EXPORT} SELECT {DAY} AS ingestion_date, count(*) AS n FROM exported GROUP BY 1",
    "export_summary": f"""{EXPORT} SELECT count(*) AS records, cast(20 AS BIGINT) AS columns,
      count(DISTINCT {DAY}) AS partitions, strftime(max(date_scraped), {TIME}) AS checkpoint FROM exported""",
    "export_verify_counts": f"""{EXPORT} SELECT {DAY} AS ingestion_date, count(*) AS expected, count(*) AS written,
      true AS verified FROM exported GROUP BY 1""",
    "export_two_runs": f"""{EXPORT}, early AS (SELECT * FROM exported WHERE date_scraped IS NULL OR date_scraped <= TIMESTAMP '{CHECKPOINT}'),
      late AS (SELECT * FROM exported WHERE date_scraped > (SELECT max(date_scraped) FROM early)),
      runs AS (SELECT 1 AS run_no, * FROM early UNION ALL SELECT 2, * FROM late)
      SELECT run_no, count(*) AS records, cast(20 AS BIGINT) AS columns, count(DISTINCT {DAY}) AS partitions, true AS files_fit,
        true AS verified, strftime(max(date_scraped), {TIME}) AS checkpoint,
        (SELECT count(*) FROM runs) AS committed FROM runs GROUP BY run_no""",
    "incremental_export": f"""{EXPORT} SELECT id, site, job_url, status, {HAS_SALARY},
      strftime(date_scraped, {TIME}) AS date_scraped FROM exported WHERE date_scraped > TIMESTAMP '{CHECKPOINT}'""",
    "sample_exact": f"""{JOBS} SELECT id, site, title, career FROM jobs
      ORDER BY md5(concat(cast(id AS VARCHAR), ':42')), id LIMIT 50""",
    "align_schema": f"""{JOBS} SELECT site, job_url, title, company, raw_location, cast(NULL AS VARCHAR) AS description,
      cast(NULL AS VARCHAR) AS date_posted, salary_min, cast(NULL AS DOUBLE) AS salary_max,
      cast(NULL AS VARCHAR) AS currency, job_type, cast(NULL AS VARCHAR) AS country_code FROM jobs""",
    "job_type_detect": f"""{JOBS} SELECT id, {JOB_TYPE} AS modality
      FROM (SELECT id, lower(coalesce(title, '') || ' ' || coalesce(job_type, '')) AS t FROM jobs)""",
    "state_detect": f"{JOBS} SELECT id, {state('raw_location')} AS state FROM jobs",
    "salary_from_text": f"""{JOBS} SELECT id, list_min(v) AS salary_min, list_max(v) AS salary_max
      FROM (SELECT id, {amounts(THOUSANDS)} AS v FROM jobs)""",
    "salary_parse": f"""{JOBS} SELECT id, v[1] AS salary_min, CASE WHEN len(v) > 1 THEN v[2] ELSE v[1] END AS salary_max
      FROM (SELECT id, {amounts(ANY_AMOUNT)} AS v FROM jobs)""",
    "salary_first_match": f"""{JOBS} SELECT id, nullif(regexp_extract(description, {q(FIRST_AMOUNT)}), '') AS salary_raw
      FROM jobs""",
    "normalize_jobs": f"{JOBS} {SEARCH_ROWS}",
    "map_phase1": f"""{JOBS} SELECT id, site, job_url, {UPPER_TITLE} AS title, {DEFAULTED}, 'México' AS country, country_code,
      {state("raw_location")} AS state, career, scraped_by, industry_niche, false AS is_premium,
      CASE job_type WHEN 'Remoto' THEN 'remoto' WHEN 'Remote' THEN 'remoto' WHEN 'Híbrido' THEN 'hibrido'
        WHEN 'Hybrid' THEN 'hibrido' WHEN 'Presencial' THEN 'presencial' ELSE job_type END AS job_type,
      salary_min, salary_max, coalesce(currency, 'MXN') AS currency, cast(NULL AS VARCHAR) AS description, date_posted,
      'PENDING_ENRICHMENT' AS status FROM jobs""",
    "parse_location": f"{JOBS}, {region_sql()} SELECT id, city, state_code, region FROM located",
    "salary_flags": f"""{JOBS} SELECT id, salary_min IS NOT NULL OR salary_max IS NOT NULL AS tiene_salario, {HAS_SALARY}
      FROM jobs""",
    "title_desc": f"""{CLEANED} SELECT id, CASE WHEN es_vacio THEN title
      ELSE coalesce(title, '') || '. ' || descripcion_limpia END AS titulo_desc FROM corpus""",
    "country_lookup": f"""{JOBS} SELECT id, CASE w WHEN 1 THEN 'colombia' WHEN 2 THEN 'peru' ELSE 'mexico' END AS search_country,
      CASE w WHEN 0 THEN 'México' WHEN 1 THEN 'CO' WHEN 2 THEN 'PE' WHEN 3 THEN 'US' END AS country,
      CASE w WHEN 1 THEN 'co' WHEN 2 THEN 'pe' ELSE 'mx' END AS subdomain,
      CASE w WHEN 1 THEN 'COP' WHEN 2 THEN 'PEN' ELSE 'MXN' END AS currency
      FROM (SELECT id, cast(right(scraped_by, 1) AS INTEGER) AS w FROM jobs)""",
    "absolute_url": r"""SELECT page_id, cast(pos AS INTEGER) AS pos, CASE WHEN starts_with(href, '/') THEN base || href ELSE href END AS link
      FROM (SELECT page_id, base, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos FROM (
        SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS base,
          [CASE WHEN left(v, 1) IN ('"', '''') THEN v[2:length(v) - 1] ELSE v END FOR v IN
            regexp_extract_all(html, '(?i)<a\b[^>]*?\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)] AS hrefs FROM pages))""",
    "crawl_frontier": f"""{JOBS} SELECT search_term, country_code, cast(page AS INTEGER) AS page,
      CASE country_code WHEN 'CO' THEN 'COP' WHEN 'PE' THEN 'PEN' ELSE 'MXN' END AS currency,
      'https://' || CASE country_code WHEN 'CO' THEN 'co' WHEN 'PE' THEN 'pe' ELSE 'mx' END
        || '.computrabajo.com/trabajo-de-' || replace(search_term, ' ', '-') || '?p=' || page AS url
      FROM (SELECT DISTINCT career AS search_term FROM jobs), (SELECT unnest(['MX', 'CO', 'PE', 'XX']) AS country_code),
        (SELECT unnest(range(1, 6)) AS page)""",
    "distinct_terms": f"{JOBS} SELECT DISTINCT career AS search_term FROM jobs",
    "clean_text": f"{CLEANED} SELECT id, descripcion_limpia AS clean FROM cleaned",
    "strip_urls": f"{JOBS} SELECT id, {drop_urls('description')} AS clean FROM jobs",
    "strip_contacts": f"{JOBS} SELECT id, {drop_contacts('description')} AS clean FROM jobs",
    "strip_markdown": f"{JOBS} SELECT id, {drop_markdown('description')} AS clean FROM jobs",
    "strip_money": f"{JOBS} SELECT id, {drop_money('description')} AS clean FROM jobs",
    "word_counts": f"{CLEANED} SELECT id, cast(n_palabras AS INTEGER) AS n_palabras, es_vacio FROM corpus",
    "lang_profile": f"WITH {PROFILE} SELECT * FROM profile",
    "lang_detect": f"{DETECTED} SELECT id, idioma_det FROM detected",
    "cleaned_corpus": f"""{DETECTED}, {region_sql().replace("FROM jobs", "FROM detected")}
      SELECT id, site, job_url, title, company, career, industry_niche, job_type, false AS is_premium, salary_min,
        salary_max, currency, salary_min IS NOT NULL OR salary_max IS NOT NULL AS tiene_salario, raw_location, city,
        state_code, region, date_posted, strftime(date_scraped, {TIME}) AS date_scraped, idioma_det, es_vacio,
        cast(n_palabras AS INTEGER) AS n_palabras, description AS descripcion_raw, descripcion_limpia,
        CASE WHEN es_vacio THEN title ELSE coalesce(title, '') || '. ' || descripcion_limpia END AS titulo_desc, status
      FROM located""",
    "nlp_corpus": f"""{NLP} SELECT id, idioma_det, descripcion_nlp, titulo_nlp, trim(titulo_nlp || ' ' || descripcion_nlp) AS texto_nlp,
      cast(n_palabras_nlp AS INTEGER) AS n_palabras_nlp, es_vacio_nlp FROM nlp""",
    "tokenize": f"""{CLEANED} SELECT id, cast(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
      FROM (SELECT id, {tokens("descripcion_limpia")} AS t FROM corpus)""",
    "stopword_filter": f"""{CLEANED} SELECT id, cast(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
      FROM (SELECT id, {without_stops(tokens("descripcion_limpia"), "idioma")} AS t FROM corpus)""",
    "token_filter": f"""{CLEANED} SELECT id, cast(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
      FROM (SELECT id, {long_words(tokens("descripcion_limpia"))} AS t FROM corpus)""",
    "lemmatize": f"""{LEMMAS} SELECT content.id, coalesce(lemmas, '') AS lemmas FROM content LEFT JOIN rebuilt USING (id)""",
    "nlp_text": f"{NLP} SELECT id, descripcion_nlp FROM nlp",
    "nlp_title": f"{NLP} SELECT id, titulo_nlp FROM nlp",
    "nlp_combined": f"{NLP} SELECT id, trim(titulo_nlp || ' ' || descripcion_nlp) AS texto_nlp FROM nlp",
    "nlp_flags": f"{NLP} SELECT id, cast(n_palabras_nlp AS INTEGER) AS n_palabras_nlp, es_vacio_nlp FROM nlp",
    "enrichment_queue": f"""{JOBS} SELECT id, site, job_url FROM jobs
      WHERE site IN ('computrabajo', 'occ') AND status = 'PENDING_ENRICHMENT' ORDER BY site, id LIMIT 100""",
    "enrichment_batches": f"""{JOBS} SELECT id, site,
      cast((row_number() OVER (PARTITION BY site ORDER BY id) - 1) // 20 + 1 AS BIGINT) AS batch_no,
      cast(ceil(count(*) OVER (PARTITION BY site) / 20.0) AS BIGINT) AS batch_count
      FROM (SELECT id, site FROM jobs WHERE site IN ('computrabajo', 'occ') AND status = 'PENDING_ENRICHMENT'
        ORDER BY site, id LIMIT 100)""",
    "recent_72h": f"""SELECT event_id, strftime(ts, {TIME}) AS ts FROM events
      WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 72 HOUR""",
    "monday_source_rule": f"""{JOBS} SELECT site, count(*) AS n FROM jobs
      WHERE site <> 'linkedin' OR isodow(date_scraped) = 1 GROUP BY site""",
    "enabled_sources": f"{JOBS} SELECT id, site FROM jobs WHERE site IN ('indeed', 'computrabajo')",
    "dedup_first": f"""{JOBS} SELECT id, job_url, site, title FROM jobs WHERE job_url IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY job_url ORDER BY id) = 1""",
    "insert_new_only": f"""{JOBS}, {STORED}, incoming AS ({SEARCH_ROWS})
      SELECT id, job_url, title, company, status FROM incoming WHERE job_url NOT IN (SELECT job_url FROM stored)
      QUALIFY row_number() OVER (PARTITION BY job_url ORDER BY id) = 1""",
    "load_counts": loads("SELECT id, job_url FROM jobs", "", "id"),
    "load_by_source": loads(
        """SELECT id, job_url, career, CASE WHEN site IN ('indeed', 'linkedin') THEN 'jobspy' ELSE site END AS load_source,
        CASE site WHEN 'computrabajo' THEN 1 WHEN 'occ' THEN 2 ELSE 0 END AS load_order FROM jobs
        WHERE job_url IS NOT NULL OR site IN ('computrabajo', 'occ')""",
        "load_source",
        "list_position(['React Developer', 'Data Engineer', 'Cloud Engineer', 'Data Analyst'], career), load_order, id",
    ),
    "mark_notified": f"{JOBS} SELECT id, CASE status WHEN 'NEW' THEN 'NOTIFIED' ELSE status END AS status FROM jobs",
    "mark_applied": f"""{JOBS} SELECT id, CASE WHEN hit THEN 'APPLIED' ELSE status END AS status,
      strftime(CASE WHEN hit THEN TIMESTAMP '{TODAY}' ELSE applied_date END, {TIME}) AS applied_date
      FROM (SELECT *, status = 'NEW' AND salary_min IS NOT NULL AS hit FROM jobs)""",
    "enrich_merge": f"""{JOBS}, {VISITS}, known AS (SELECT job_url, max(salary_min) AS k FROM jobs GROUP BY job_url)
      SELECT id, job_url, CASE WHEN k IS NULL THEN low ELSE salary_min END AS salary_min,
        CASE WHEN k IS NULL AND s <> chr(1) THEN high ELSE salary_max END AS salary_max, found AS description
      FROM jobs JOIN known USING (job_url) JOIN results USING (job_url) JOIN visits USING (job_url)""",
    "enrich_update": UPDATED_ROWS,
    "enrichment_summary": f"""{UPDATED} SELECT count(*) FILTER (visited AND found IS NOT NULL) AS enriched,
      count(*) FILTER (visited AND found IS NULL) AS orphaned,
      count(*) FILTER (NOT visited AND status = 'PENDING_ENRICHMENT' AND site IN ('computrabajo', 'occ')) AS remaining
      FROM updated""",
    "failure_streaks": """WITH rows AS (SELECT user_id, event_id, ts, event_type = 'error' AS fail,
        sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER w AS island FROM events WHERE event_type <> 'signup'
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      runs AS (SELECT *, sum(CASE WHEN fail THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS pos FROM rows)
      SELECT user_id, event_id, cast(pos AS BIGINT) AS run_length FROM runs WHERE fail AND pos % 3 = 0""",
    "audit_summary": f"""{JOBS} SELECT count(*) AS total,
      count(*) FILTER (title IS NULL OR job_url IS NULL) AS missing_title_or_url, count(salary_min) AS with_salary,
      {pct("count(salary_min)", "count(*)")} AS salary_pct FROM jobs""",
    "audit_duplicates": f"{JOBS} SELECT job_url, count(*) AS n FROM jobs GROUP BY job_url HAVING count(*) > 1",
    "audit_constraints": f"{JOBS} "
    + " UNION ALL ".join(
        f"SELECT {q(c)} AS column_name, {q(kind)} AS check_name, count(*) FILTER ({test}) AS violations FROM jobs"
        for c, kind, test in CHECKS
    ),
    "top_regions": f"""{JOBS}, {region_sql()} SELECT region, count(*) AS n FROM located GROUP BY region
      ORDER BY n DESC, region LIMIT 10""",
    "corpus_summary": f"""{CLEANED} SELECT count(*) AS total, count(*) FILTER (NOT es_vacio) AS usable,
      {pct("count(*) FILTER (NOT es_vacio)", "count(*)")} AS usable_pct, count(*) FILTER (es_vacio) AS empty,
      {pct("count(*) FILTER (es_vacio)", "count(*)")} AS empty_pct,
      count(*) FILTER (salary_min IS NOT NULL OR salary_max IS NOT NULL) AS with_salary,
      {pct("count(*) FILTER (salary_min IS NOT NULL OR salary_max IS NOT NULL)", "count(*)")} AS with_salary_pct
      FROM corpus""",
    "median_words_by_career": f"""{CLEANED} SELECT career, cast(median(n_palabras) AS DOUBLE) AS median_words FROM corpus
      WHERE NOT es_vacio GROUP BY career ORDER BY median_words DESC, career LIMIT 10""",
    "language_dist": f"{DETECTED} {shares('detected', 'idioma_det', 'es_vacio')}",
    "nlp_summary": f"""{NLP} SELECT count(*) AS total, count(*) FILTER (NOT es_vacio_nlp) AS usable_nlp,
      {pct("count(*) FILTER (NOT es_vacio_nlp)", "count(*)")} AS usable_nlp_pct,
      count(*) FILTER (es_vacio_nlp) AS empty_nlp, count(*) FILTER (es_vacio_nlp AND NOT es_vacio) AS newly_empty FROM nlp""",
    "nlp_language_dist": f"{NLP} {shares('nlp', 'idioma_det', 'es_vacio_nlp')}",
    "median_words_by_day": f"""{CLEANED} SELECT career, count(*) AS n, true AS exact_rank_fits FROM corpus
      WHERE NOT es_vacio GROUP BY career""",
    "median_tokens_by_career": f"""{NLP} SELECT career, cast(median(n_palabras_nlp) AS DOUBLE) AS median_words FROM nlp
      WHERE NOT es_vacio_nlp GROUP BY career ORDER BY median_words DESC, career LIMIT 10""",
    "before_after_sample": f"""{NLP}, {region_sql().replace("FROM jobs", "FROM nlp")}
      SELECT id, career, city, left(descripcion_limpia, 120) AS before_text, left(descripcion_nlp, 120) AS after_text
      FROM located WHERE NOT es_vacio_nlp AND idioma_det = 'es'
      ORDER BY md5(concat(cast(id AS VARCHAR), ':42')), id LIMIT 3""",
    "followup_score": f"""{JOBS}, aged AS (SELECT id, company, title, status,
        {{0}} AS days_since_update, {{1}} AS applied FROM jobs WHERE status IN ('APPLIED', 'SCREENING', 'INTERVIEW'))
      SELECT id, company, title, status, days_since_update, cast(
        CASE WHEN status IN ('APPLIED', 'SCREENING') THEN 5 ELSE 0 END
        + CASE WHEN days_since_update >= 14 THEN 5 WHEN days_since_update >= 7 THEN 3 WHEN days_since_update >= 3 THEN 1 ELSE 0 END
        + CASE WHEN applied >= 21 THEN 3 WHEN applied >= 14 THEN 2 WHEN applied >= 7 THEN 1 ELSE 0 END AS INTEGER) AS followup_score
      FROM aged""".format(*[
        f"cast(trunc((epoch(TIMESTAMP '{TODAY}') - epoch(date_trunc('second', {c}))) / 86400.0) AS INTEGER)"
        for c in ("coalesce(last_updated, applied_date)", "applied_date")
    ]),
    "new_jobs_top20": f"""{JOBS} SELECT id, title, company, raw_location, site, salary_min, salary_max, job_url,
      strftime(date_scraped, {TIME}) AS date_scraped FROM jobs WHERE status = 'NEW' ORDER BY id LIMIT 20""",
    "report_open_jobs": f"""{JOBS} SELECT id, title, company, raw_location, {state("raw_location")} AS state, job_type,
      salary_min, salary_max, site, job_url, date_posted, {shifted("date_scraped")} AS local_date_scraped
      FROM jobs WHERE status IN ('NEW', 'APPLIED')""",
    "report_cards": f"""{JOBS} SELECT id,
      CASE WHEN coalesce(job_type, '') = '' THEN '' ELSE '[' || upper(job_type) || '] ' END || {printable("title")}
        || ' (' || upper(left(site, 1)) || lower(substr(site, 2)) || ')' AS title_line,
      {filled("company", "Empresa confidencial")} || ' | ' || {filled(state("raw_location"), "México")} || ' ('
        || {printable("raw_location")} || ')' AS place_line,
      CASE WHEN salary_min IS NULL THEN 'Salario no mostrado' ELSE '$' || format('{{:,.0f}}', salary_min)
        || CASE WHEN salary_max IS NULL THEN '' ELSE ' - $' || format('{{:,.0f}}', salary_max) END END AS salary_line,
      left({filled("description", "Sin descripcion disponible")}, 400) || '...' AS description_text, job_url AS link,
      {shifted("date_scraped")} AS local_date_scraped FROM jobs WHERE status = 'NEW'""",
    "cap_results": f"""{JOBS} SELECT id, career, site, cast(position AS INTEGER) AS position FROM (
      SELECT id, career, site, row_number() OVER (PARTITION BY career ORDER BY site, id) AS position FROM jobs)
      WHERE position <= 25""",
    "pagination_cutoff": """WITH stops AS (SELECT user_id, min(event_id) FILTER (event_type = 'error') AS e,
        min(event_id) FILTER (event_type = 'signup') AS n FROM events GROUP BY user_id)
      SELECT user_id, event_id AS page, event_type = 'error' AS is_empty, event_type <> 'signup' AS has_next
      FROM events JOIN stops USING (user_id) WHERE (e IS NULL OR event_id < e) AND (n IS NULL OR event_id <= n)""",
    "extract_cards": r"""SELECT page_id, cast(no AS INTEGER) AS card_no, nullif(title, '') AS title, link AS job_url FROM (
      SELECT page_id, unnest(range(len(hrefs))) AS no, unnest(hrefs) AS link, unnest(titles) AS title FROM (
        SELECT page_id, regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
          regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS titles
        FROM (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages)))""",
    "site_cards": """SELECT doc_id AS page_id, cast(CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS card_no, 'computrabajo' AS site,
        concat('https://mx.computrabajo.com/oferta/', doc_id) AS job_url, concat('Puesto', doc_id) AS title,
        concat('Empresa ', doc_id % 37) AS company, 'León, Gto.' AS raw_location, concat('Hace ', doc_id % 9, ' días') AS date_posted,
        CASE WHEN doc_id % 4 = 0 THEN 20000.5 WHEN doc_id % 2 = 0 THEN 12000.0 END::DOUBLE AS salary_min,
        CASE WHEN doc_id % 4 = 0 THEN 20000.5 WHEN doc_id % 2 = 0 THEN 15000.0 END::DOUBLE AS salary_max,
        CASE WHEN doc_id % 6 = 0 THEN 'Híbrido' WHEN doc_id % 3 = 0 THEN 'Remoto' END AS job_type, doc_id % 7 <> 0 AS has_next FROM documents
      UNION ALL SELECT doc_id, 0, 'computrabajo', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, doc_id % 7 <> 0 FROM documents WHERE doc_id % 5 = 0
      UNION ALL SELECT doc_id, 0, 'occ', CASE WHEN doc_id % 5 <> 0 THEN concat('https://www.occ.com.mx/empleo/oferta/', doc_id, '/') END,
        concat('Puesto ', doc_id), concat('Empresa', doc_id % 37), CASE WHEN doc_id % 4 <> 0 THEN 'CDMX' END, 'Ayer',
        CASE WHEN doc_id % 3 = 0 THEN 5000.0 END, CASE WHEN doc_id % 3 = 0 THEN 5000.0 END, NULL, true FROM documents""",
    "extract_detail": f"""SELECT page_id, {text_of("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)", chr(10))} AS description,
      nullif(regexp_extract({text_of("html", " ")}, {q(FIRST_AMOUNT)}), '') AS salary_raw FROM pages""",
    "page_text": f"SELECT page_id, {text_of('html', ' ')} AS page_text FROM pages",
    "page_fields": f"""SELECT page_id, {text_of("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)", " ")} AS title,
      {text_of("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)", " ")} AS heading,
      array_to_string([CASE WHEN left(v, 1) IN ('"', '''') THEN v[2:length(v) - 1] ELSE v END FOR v IN
        regexp_extract_all(html, '(?i)<a\\b[^>]*?\\shref\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1)], ' ') AS links FROM pages""",
    "term_frequencies": f"{counted_terms(1, 1)} SELECT * FROM counts",
    "bow_top_terms": f"{counted_terms(1, 1)} SELECT * FROM counts ORDER BY n DESC, term LIMIT 3000",
    "ngram_counts": f"{counted_terms(2, 3)} SELECT * FROM counts",
    "tfidf_top_terms": f"""{TFIDF} SELECT term, any_value(n) AS n, any_value(n_docs) AS n_docs, round(sum(w / norm), 6) AS tfidf
      FROM weighted JOIN norms USING (id) GROUP BY term""",
    "tfidf_matrix": f"{TFIDF} SELECT id, term, round(w / norm, 6) AS weight FROM weighted JOIN norms USING (id)",
    "stream_export_rows": f"""{EXPORT} SELECT id, site, status, {HAS_SALARY}, {DAY} AS ingestion_date FROM exported""",
    "stream_enrich_update": UPDATED_ROWS,
    "stream_status": UPDATED_ROWS,
    "stream_first_within": "SELECT event_id, event_type FROM events WHERE ts IS NOT NULL",
}
ORACLES["stream_insert_new"] = ORACLES["insert_new_only"]
