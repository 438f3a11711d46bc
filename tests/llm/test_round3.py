"""Whitening, token files and fill-in-the-middle against plain versions of the same."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobmill.llm import encoder, fill_in_middle, token_files, tool_calls, vector_search, warc, whitening

DOCS = "doc_id long, text string, row int, start string, part string, output string, h1 string, ids string"
VECTORS = "vec_id long, embedding array<float>, x int, n string, whitened string, pos int"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 1, "s", "p", "o", "h", "i") for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    signs = ["a", "é", "漢", "😀", " ", "<", "P", ">", "word ", "<P", "\n"]
    made = ["".join(rng.choices(signs, k=rng.randrange(0, 400))) for _ in range(150)]
    shared = " ".join(f"w{rng.randrange(50_000)}" for _ in range(3000))
    made += ["", None, " ", "plain <S> text", "x<M>", "aé" * 30_000, shared, "ü " + shared, shared + " end", "a" * 100_000]
    rows = list(enumerate(made))
    return [*rows, rows[5], (5, "another text"), (None, "no id"), (None, None), (None, "no id")]


# ---- fill in the middle


def changed(doc, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < 20 else "psm", a, b - a, out


def test_fill_in_middle(spark, texts):
    docs = documents(spark, texts)
    got = fill_in_middle.fill_in_middle(docs)
    back = got.withColumn("text", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(str(tuple(r)[:-1]) for r in back) == sorted(str((i, *changed(i, t))) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in texts)
    forms = {r["form"] for r in back}
    assert forms == {"plain", "psm", "spm"}
    assert fill_in_middle.digests(docs.limit(0)).count() == 0


def test_chunks_are_shared_and_bounded():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdé ", k=2_500_000)).encode()
    ends = fill_in_middle.ends(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and max(sizes) <= fill_in_middle.LONGEST and min(sizes[:-1]) >= 200
    assert all(text[e] & 0xC0 != 0x80 for e in ends[:-1])
    other = fill_in_middle.ends(b"some other words first " + text[1000:])
    shifted = {e - 23 + 1000 for e in other}
    assert len(shifted & set(ends)) > 0.99 * len(ends)
    chunks = fill_in_middle.Chunks()
    total = len(fill_in_middle.cut(text[:200_000], chunks).bounds)
    before = chunks.hits
    fill_in_middle.cut(b"\n" + text[:200_000], chunks)
    assert chunks.hits - before > 0.9 * total > 50
    small = fill_in_middle.Chunks(budget=64 << 10)
    fill_in_middle.cut(text, small)
    assert sum(map(len, small.new)) + sum(map(len, small.old)) <= 64 << 10


def test_summaries_combine():
    for at in range(12):
        data = "éa<S>漢bc".encode()
        assert fill_in_middle.summary(data[:at]) + fill_in_middle.summary(data[at:]) == fill_in_middle.summary(data)
    assert not (fill_in_middle.summary(b"<") + fill_in_middle.summary(b"S") + fill_in_middle.summary(b"x>")).marked
    assert (fill_in_middle.summary(b"<") + fill_in_middle.summary(b"S") + fill_in_middle.summary(b">")).marked


# ---- token files


@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_file(public_tokenizers.path(encoder.TOKENIZER))


def test_encoder_equals_the_tokenizer(coder):
    rng = random.Random(11)
    signs = [*"abZé.,'!?-0٣ß漢😀", " ", "\n", "\x1c", " ", "́", "'s", "'LL", "don't", "İ", "ﬁ", "<|endoftext|>", "<|", "x.", "9,", "$$$"]
    made = ["".join(rng.choices(signs, k=rng.randrange(0, 14))) for _ in range(30_000)]
    with encoder.task_encoder(budget=1 << 20) as words:
        got = [words.text(t).tolist() for t in made]
    assert got == [e.ids for e in coder.encode_batch(made, add_special_tokens=False)]
    assert not words and not words.old


def test_token_files(spark, texts, coder, tmp_path):
    docs = documents(spark, texts)
    expected = []
    for doc, text in texts:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc is not None, doc or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for per_file in (20_000, 10**9):
        got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.round_trip(docs, per_file).collect())
        assert [r[0] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
        placed = [(d is not None, d or 0, n, crc) for _, d, n, crc in got]
        assert [p[:2] for p in placed] == sorted(p[:2] for p in expected)
        assert sorted(placed) == sorted(expected)
    assert token_files.round_trip(docs.limit(0)).count() == 0


def test_token_files_prune_by_metadata(spark, tmp_path):
    from pyarrow import orc

    rng = random.Random(2)
    docs = spark.createDataFrame([(i * 2, f"{rng.random()} " * 20) for i in range(6000)], "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_files.write(docs, path, per_file=200_000)
    files = sorted((tmp_path / "tokens").glob("*.orc"))
    assert len(files) > 3
    firsts = [orc.read_table(f, columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    assert [x for f in firsts for x in f] == sorted(range(0, 12000, 2))

    def read_rows(ids):
        found = token_files.lookup(spark, path, ids)
        got = [r["doc_id"] for r in found.collect()]
        plan = found._jdf.queryExecution().executedPlan()
        while "FileSourceScan" not in plan.getClass().getName():
            plan = plan.children().head()
        return got, plan.metrics().apply("numOutputRows").value()

    assert read_rows([4000]) == ([4000], 1000) or read_rows([4000])[1] <= 1000
    # Inside the range of a row group, but not there: the Bloom filters rule it out.
    assert read_rows([4001]) == ([], 0)


# ---- whitening


def plain_whitening(vectors, components=32):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    away = n * x.astype(object) - sums.astype(object)
    c = x - sums / n
    values, directions = np.linalg.eigh(c.T @ c / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    return n, (away**2).sum(axis=1), c @ directions / np.sqrt(values), values / np.trace(c.T @ c / n)


def check_whitening(spark, rows, good, components):
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    n, deviations, white, explained = plain_whitening([r[1] for r in good], components)
    assert len(got) == len(good) * components
    by = {(r["vec_id"], r["component"]): r for r in got}
    ids = [r[0] for r in good]
    table = np.array([[by[i, c + 1]["whitened"] for c in range(components)] for i in ids])
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table - white * signs).max() < 1e-7
    assert [by[i, 1]["deviation"] for i in ids] == deviations.tolist()
    assert {r["n"] for r in got} == {n}
    assert np.allclose([by[ids[0], c + 1]["explained"] for c in range(components)], explained, rtol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-6


def extra(i, v):
    return i, v if v is None else [c if c is None else float(np.float32(c)) for c in v], 1, "n", "w", 2


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(4)
    scales = np.linspace(1, 3, 64)
    good = [extra(i, (rng.standard_normal(64) * scales).tolist()) for i in range(400)]
    good += [extra(1000 + i, good[0][1]) for i in range(200)]
    bad = [extra(5000, None), extra(5001, [None, *[1.0] * 63]), extra(5002, [float("nan")] * 64), extra(5003, [float("inf")] * 64),
           extra(5004, [1.0] * 3), extra(5005, []), extra(5006, [3e38] * 64)]
    check_whitening(spark, good + bad, good, 32)


def test_whitening_of_a_wide_spectrum_and_few_dimensions(spark):
    rng = np.random.default_rng(5)
    scales = np.geomspace(3000, 0.5, 64)
    good = [extra(i, (rng.standard_normal(64) * scales + 7).tolist()) for i in range(300)]
    check_whitening(spark, good, good, 32)
    few = [extra(i, rng.standard_normal(5).tolist()) for i in range(50)]
    check_whitening(spark, few, few, 5)


def test_whitening_without_spread(spark):
    same = [extra(i, [1.0, 2.0]) for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(same, VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    line = [extra(i, [float(i), 2.0 * i]) for i in range(50)] + [extra(None, [3.0, 6.0])] * 2
    got = whitening.whiten(spark.createDataFrame(line, VECTORS)).collect()
    assert len(got) == 52 and {r["component"] for r in got} == {1} and got[0]["identity_error"] < 1e-9


# ---- cases named by reviews


def test_stages_keep_columns_with_clashing_names(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, _row long, _copy int, _copies int, _mix_doc_id int, _n int, name string"
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(i, t, "en", "s", 1, 77, 5, 6, 7, 8, "n") for i, t in enumerate([long, long, long + " end", None, "", "a b c d e f g", long[:900]])]
    rows += [rows[0], (None, long, None, None, None, 77, 5, 6, 7, 8, "n"), (None, None, None, None, None, 77, 5, 6, 7, 8, "n")]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, "")
            assert out.columns == docs.columns, name
            assert {tuple(r)[5:] for r in out.collect()} <= {(77, 5, 6, 7, 8, "n")}, name
        assert corpus_pipeline.STAGES[-1][1](spark, table, "").count() == table.count()
    kept = corpus_pipeline.exact(spark, docs, "").collect()
    assert sorted((str(r["doc_id"]) for r in kept), key=str) == ["0", "2", "3", "5", "6"]


def test_captures_after_a_shuffle(spark):
    pages = spark.createDataFrame([(i, "u", "x" * 2000 + str(i % 3)) for i in range(2000)], "page_id long, url string, html string")
    got = warc.page_captures(pages.repartition(7)).where("record_type = 'revisit'")
    assert {r[0] for r in got.select("refers_to").distinct().collect()} == {1997, 1998, 1999}


def test_json_of_odd_values():
    assert tool_calls.canonical({"a": "x\ud800é"}) == '{"a":"x\\ud800é"}'
    assert tool_calls.canonical({"a": "\ud800"}).encode()
    assert tool_calls.parsed('{"top":1e999}') is ... and tool_calls.parsed("NaN") is ...
    assert [tool_calls.parsed(t) for t in ("1", "1.0", "1e0", "1.5")] == [1, 1, 1, 1.5]
    assert isinstance(tool_calls.parsed("1.0"), int) and tool_calls.parsed('{"a":1,"a":2}') == {"a": 2}
    assert tool_calls.fits(None, {"type": ["string", "null"]}) and not tool_calls.fits(1, {"type": ["string", "null"]})


def test_calls_with_surrogates(spark):
    calls = spark.createDataFrame([(1, 0, "c", "search", '{"query":"\\ud800","top":1.0}', None)], "conv_id long, turn int, call_id string, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([("c", 1, "r")], "call_id string, turn int, content string")
    row = tool_calls.link(calls, results).first()
    assert row["status"] == "ok" and '"query":"\\ud800","top":1' in row["canonical"]


def test_search_of_large_components(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * 5e6 for _ in range(3)]) for i in range(120)]
    got = vector_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    for q in (0, 50, 100):
        best = sorted(((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q))[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, -s) for s, i in best]
    huge = spark.createDataFrame([(0, [1e30, 0.0]), (1, [0.5, 1.0]), (2, [1e8, -1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit form"):
        vector_search.top_k(huge).collect()
    small = spark.createDataFrame([(0, [0.0, 0.5]), (1, [1e30, 1.0]), (2, [-1e30, 2.0])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in vector_search.top_k(small).orderBy("rank").collect()] == [(2, 65536), (1, 32768)]
