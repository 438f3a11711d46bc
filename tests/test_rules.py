"""Unit tables of the column rules."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobmill.functions import html, location, postings, report, salary, text, tokens


def apply(spark, rule, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = rows.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()
    return [tuple(r.o) if hasattr(r.o, "_fields") or hasattr(r.o, "asDict") else r.o for r in out]


def test_parse_location(spark):
    cases = {
        "León, GUA, MX": ("León", "GUA", "Bajío"),
        "Irapuato, GUA, MX": ("Irapuato", "GUA", "Bajío — Irapuato"),
        "Desde casa": ("Remoto", None, "Remoto"),
        "Trabajo REMOTO total": ("Remoto", None, "Remoto"),
        "remotoé": ("remotoé", None, "Sin dato"),
        "New York, NY, US": ("New York", "NY", "Internacional"),
        "Xalapa, XXX, MX": ("Xalapa", "XXX", "XXX"),
        "Zapopan,JAL, MX\n": ("Zapopan", "JAL", "Guadalajara"),
        "CDMX": ("CDMX", None, "Sin dato"),
        "  ": (None, None, "Sin dato"),
        None: (None, None, "Sin dato"),
    }
    assert apply(spark, location.parse_location, list(cases)) == list(cases.values())


def test_detect_state(spark):
    cases = {"Guadalajara": "Jalisco", "León": None, "Qro, México": "Querétaro", "leon, jalisco": "Guanajuato", None: None}
    assert apply(spark, location.detect_state, list(cases)) == list(cases.values())


def test_salary_rules(spark):
    ranges = {
        "$12,000 a $13,000": (12000.0, 13000.0),
        "de $ 15,000 a $9,000 o $11,000": (9000.0, 15000.0),
        "$15,000": (15000.0, 15000.0),
        "$900": (None, None),
        "": (None, None),
        None: (None, None),
    }
    assert apply(spark, salary.salary_from_text, list(ranges)) == list(ranges.values())
    parsed = {
        "$20,000.50 - $10,000": (20000.5, 10000.0),
        "1 2 3": (1.0, 2.0),
        "A convenir": (None, None),
        ",": (None, None),
        None: (None, None),
    }
    assert apply(spark, salary.parse_salary, list(parsed)) == list(parsed.values())
    first = {"pago $ 9,500 – $12,000 mensual": "$ 9,500 – $12,000", "nada": None, "$5": "$5"}
    assert apply(spark, salary.first_amount, list(first)) == list(first.values())


def test_modality(spark):
    rows = spark.createDataFrame([("Dev Híbrido", "Remoto"), ("Dev Híbrido", "CDMX"), (None, None)], "t string, l string")
    got = [r.o for r in rows.select(postings.detect_job_type(F.col("t"), F.col("l")).alias("o")).collect()]
    assert got == ["remoto", "hibrido", "presencial"]
    assert apply(spark, postings.map_job_type, ["Remote", "Híbrido", "fulltime", None]) == ["remoto", "hibrido", "fulltime", None]


def test_numbers_and_flags(spark):
    assert apply(spark, postings.to_number, ["1.5", "x", "NaN", None]) == [1.5, None, None, None]
    assert apply(spark, lambda c: postings.strict_bool(c, True), ["True", "False", "true", None]) == [True, False, True, True]
    assert apply(spark, lambda c: postings.default(c, "d"), ["", None]) == ["", "d"]


CLEAN = {
    "**Hola** *mundo*": "Hola mundo",
    "ver https://a.mx/x?y=1 y www.b.mx fin": "ver y fin",
    "correo a.b@c.mx, gracias": "correo gracias",
    "tel 5512345678 o (55) 1234-5678 ya": "tel o ya",
    "a1234567890 queda": "a1234567890 queda",
    "Sueldo $12,000.00 o 500 pesos y 3 años": "Sueldo o y 3 años",
    "\\- uno\\n\\* dos\\tfin\\r": "uno\ndos fin",
    "x\n\n\n\n• y": "x\ny",
    "  \u00a0 ": "",
    "#empleo ya": "ya",
    "$ MXN": "$ MXN",
    None: "",
}


def test_clean_description(spark):
    assert apply(spark, text.clean_description, list(CLEAN)) == list(CLEAN.values())


STEPS = [
    ("unescape", "a\\nb\\tc\\r \\-x\\*", "a\nb c -x*"),
    ("drop_urls", "v https://a.mx/x?y=1 y", "v   y"),
    ("drop_emails", "c a@b.c d", "c   d"),
    ("drop_phones", "t 5512345678 (55) 1234-5678", "t    "),
    ("drop_emphasis", "**a** *b*", "a b"),
    ("drop_bullets", "- a\n  • b", "a\nb"),
    ("drop_hashtags", "#x y", "  y"),
    ("drop_money", "$1,000 o 5 pesos", "  o  "),
    ("collapse_blanks", "a  \t b c", "a b c"),
    ("collapse_newlines", "a\n\n\n\nb\n\nc", "a\n\nb\n\nc"),
]


@pytest.mark.parametrize("step,raw,clean", STEPS)
def test_cleaning_step(spark, step, raw, clean):
    assert apply(spark, getattr(text, step), [raw]) == [clean]


PIECES = st.sampled_from(
    ["@", ".", "a@b.c", " ", "\n", "*", "**", "-", "•", "#", "ñ", "x", "12", ",", "$", "pesos", "MXN", "\\", "n", "www.", "http://", "(", ")", "55", "1234567890", "\u00a0", "_"]
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=60, max_size=120))
def test_clean_texts_hold_no_edges_or_runs(spark, values):
    for clean in apply(spark, text.clean_description, values):
        assert clean == clean.strip()
        assert "  " not in clean and "\t\t" not in clean and "\n\n\n" not in clean


def test_long_runs_stay_fast(spark):
    values = ["9" * 300_000, "a" * 300_000 + "@", " " * 300_000 + "x", "." * 300_000, "\\" * 100_000]
    assert len(apply(spark, text.clean_description, values)) == 5


def test_word_count(spark):
    assert apply(spark, text.word_count, ["a b\u00a0c\n d", "", None]) == [4, 0, 0]


def test_tokens(spark):
    got = apply(spark, tokens.tokenize, ["Full-Stack, C++ y MLOps_2 - ¡ya!", "", None])
    assert got == [["full-stack", "c", "y", "mlops_2", "-", "ya"], [], []]
    kept = apply(spark, tokens.without_short_or_numeric, [["ab", "abc", "2024", "20a"]], "array<string>")
    assert kept == [["abc", "20a"]]
    rows = spark.createDataFrame([("es",), ("en",), ("otro",), (None,)], "lang string")
    words = F.array(*[F.lit(w) for w in ("the", "para", "python")])
    got = [r.o for r in rows.select(tokens.without_stop_words(words, F.col("lang")).alias("o")).collect()]
    assert got == [["the", "python"], ["para", "python"], ["python"], ["python"]]
    grams = apply(spark, lambda c: tokens.ngrams(c, 1, 3), [["a", "b", "c"], ["a"], []], "array<string>")
    assert grams == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_report_rules(spark):
    assert apply(spark, report.printable, ["“a” – ’b’ 😀 ñ", None]) == ["\"a\" - 'b' ? ñ", ""]
    rows = spark.createDataFrame([(None, 1.0), (12345.5, None), (2.5, 1e6)], "a double, b double")
    got = [r.o for r in rows.select(report.salary_label(F.col("a"), F.col("b")).alias("o")).collect()]
    assert got == ["Salario no mostrado", "$12,346", "$2 - $1,000,000"]
    assert apply(spark, report.card_text, ["x" * 500, ""]) == ["x" * 400 + "...", "Sin descripcion disponible..."]


def test_visible_text(spark):
    page = "<html><head><title>T</title><style>p{}</style></head><body><!-- no --><p> a <b>b</b>&nbsp;</p><script>x</script>&lt;c&gt; &amp;lt; &#241;&#xe9; &unknown; &amp<br>&ampx; &</body>"
    assert apply(spark, html.visible_text, [page]) == ["T a b <c> &lt; ñé &unknown; & &ampx; &"]


@pytest.mark.parametrize("href,link", [("/a", "https://s/a"), ("https://o/b", "https://o/b"), (None, None)])
def test_links(spark, href, link):
    assert apply(spark, lambda c: postings.absolute_url(F.lit("https://s"), c), [href]) == [link]


def test_links_of_all_quotings_and_long_references(spark):
    page = """<a href="/a">x</a><a class=k href='/b c'>y</a><A HREF = /d>z</a><a name=q>n</a>"""
    assert apply(spark, html.link_targets, [page]) == [["/a", "/b c", "/d"]]
    assert apply(spark, html.visible_text, ["<p>&apos;&#0000000065;&#x00000042;</p>"]) == ["'AB"]
