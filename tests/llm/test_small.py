"""The operators on small tables with nulls, empty and long texts, ties and repeated rows."""

import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobmill.llm import (
    apportion,
    exact_dedup,
    hashing,
    near_dedup,
    packing,
    sharding,
    tool_calls,
    toxicity,
    vector_search,
    warc,
    weak_quality,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, name string"


def rows(texts, sources=None):
    return [
        (i, t, None if i % 3 else "en", (sources or ["b", "a", None])[i % 3], None, 7, "extra") for i, t in enumerate(texts)
    ]


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    texts = ["a b c", "a  b\tc", None, "", " ", "a b c", long, long, long + " end", "one", "é ñ " * 50, "\n"]
    data = rows(texts)
    data += [data[0], (None, "a b c", None, "a", None, 7, "x"), (None, None, None, None, None, 7, "x")]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def plain(text):
    return " ".join(exact_parts(text or ""))


def exact_parts(text):
    import re

    return re.split(r"[\x20\x09-\x0D]+", text)


def test_exact_groups(docs, none):
    got = exact_dedup.exact_groups(docs, block=16).collect()
    groups = {}
    for d in docs.collect():
        groups.setdefault(plain(d.text), []).append(d.doc_id)
    want = sorted((str(i), str(min((x for x in g if x is not None), default=None)), len(g)) for g in groups.values() for i in g)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_groups(none).count() == 0
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns


def test_hot_blocks_get_one_name(spark):
    texts = ["same text " * 30] * 5000 + [f"own {i}" for i in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = exact_dedup.exact_groups(df.repartition(8), block=32)
    assert got.where("kept").count() == 3001
    assert got.where("group_size = 5000 AND keep_id = 0").count() == 5000


def test_near_groups(spark, docs, none):
    rng = random.Random(4)
    words = [f"q{rng.randrange(400)}" for _ in range(300)]
    texts = []
    for i in range(60):
        copy = list(words)
        for _ in range(i % 12):
            copy[rng.randrange(300)] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += ["a b", "A  b", "a b c", "", None, "x y z w v u", "x y z w v u t"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r for r in near_dedup.near_groups(df).collect()}
    assert [got[i].component_id for i in range(len(texts))] == label
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert near_dedup.near_groups(docs).count() == docs.count()
    assert near_dedup.near_groups(none).count() == 0


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_stage_links_from_080(spark):
    texts = []
    for group in range(40):
        words = [f"g{group}w{i}" for i in range(204)]
        texts.append(" ".join(words))
        # Each changed word far from others touches five shingles of 200.
        for changed in (group % 3 + 3, group % 4 + 4):
            copy = list(words)
            for c in range(changed):
                copy[10 + 20 * c] = f"new{group}x{changed}x{c}"
            texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    label, between = list(range(len(texts))), 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared, union = len(a & b), len(a | b)
            if 100 * shared >= 80 * union:
                between += 100 * shared < 85 * union
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    assert between > 20 and len(set(label)) > 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup.keep_one(df).collect()) == sorted(set(label))
    with_85 = near_dedup.near_groups(df).where("kept").count()
    assert with_85 > len(set(label))


def test_stages_keep_single_rows(spark):
    own = " ".join(f"own{i}" for i in range(40))
    other = " ".join(f"other{i}" for i in range(40))
    data = [(7, own), (7, own), (7, other), (9, other), (None, own), (None, "alone"), (None, "alone"), (3, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)

    def found(kept):
        return sorted(map(str, map(tuple, kept.collect())))

    want = sorted(map(str, [(7, own), (7, other), (None, "alone"), (3, None)]))
    assert found(exact_dedup.keep_first(df)) == want
    assert found(near_dedup.keep_one(df)) == want


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for n in (0, 1, 40, 700, 3000):
        other = np.append(base[n:], rng.integers(0, 2**63, n // 2).astype(np.uint64))
        differ = (near_dedup.parity(base) ^ near_dedup.parity(other)).view(np.uint64)
        found = sum(int(x).bit_count() for x in differ)
        assert found <= n + n // 2 and (found == 0) == (n == 0)


def test_sainte_lague(spark):
    votes = [(1, k, v) for k, v in enumerate([53, 24, 23, 0])] + [(2, 0, 0)]
    df = spark.createDataFrame(votes, "g int, k int, v long").withColumn("seats", F.lit(7).cast("long"))
    got = {(r.g, r.k): r.quota for r in apportion.sainte_lague(df, ["g"], "k", "v", "seats").collect()}
    assert got == {(1, 0): 3, (1, 1): 2, (1, 2): 2, (1, 3): 0, (2, 0): 0}


def test_mix(spark, docs, none):
    got = apportion.mix(docs).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    for source in ("a", "b", None):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 64 or own[0].target == 2 * own[0].source_size
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * sum(r.size for r in got)) < 1e-6
    assert apportion.mix(none).count() == 0
    mixed = apportion.mixed(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    assert mixed.columns == docs.columns


def test_shard(spark, docs, none):
    got = sharding.shard(docs).collect()
    assert len(got) == docs.count()
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.text_crc32 for r in got if r.doc_id == 10} == {zlib.crc32(("é ñ " * 50).encode())}
    assert sharding.shard(none).count() == 0


def test_slot_map_edits(spark):
    loads = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") * 10).alias("bytes"), F.lit(1).cast("long").alias("n_rows"))
    first = sharding.first_map(spark, loads, 64, 4)
    second = sharding.rebalance(first, 4)
    sums = [r[1] for r in second.groupBy("shard").agg(F.sum("bytes")).collect()]
    assert max(sums) - min(sums) <= 640 and second.select("version").first()[0] == 2
    third = {r.virtual_slot: r.shard for r in sharding.grow(second, 4).collect()}
    moved = [s for v, s in third.items() if s != {r.virtual_slot: r.shard for r in second.collect()}[v]]
    assert moved and set(moved) == {4}


def test_long_data_is_hashed_in_parts(monkeypatch):
    rng = random.Random(4)
    text = " ".join("x" * rng.randrange(1, 40) + str(rng.randrange(99)) for _ in range(3000)) + "\t" + "y" * 5000 + " end"
    whole = hashing.joined_hashes(text.encode())[0]
    monkeypatch.setattr(hashing, "CHUNK", 1000)
    assert b"".join(hashing.pieces(text.encode())) == text.encode()
    got = hashing.word_hashes(["a b", text, None, "", text + " z"])
    assert [len(x) for x in got] == [2, 3002, 0, 0, 3003]
    assert (got[1] == whole).all() and (got[4][:-1] == whole).all()


def test_long_words_with_equal_polynomials():
    a, b = b"a", b"b"
    for _ in range(11):
        a, b = a + b, b + a
    assert hashing.joined_hashes(a)[0][0] != hashing.joined_hashes(b)[0][0]


def test_pack(docs, none):
    got = packing.pack(docs).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()}
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert sum(r.length for r in own) <= 4096
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
    assert len(bins) <= -(-sum(r.length for r in got) // 4096) + 1
    assert packing.pack(none).count() == 0


def test_crossover_keeps_every_item():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 4000, 300)
    people = []
    for seed in (1, 2):
        bins = []
        packing.best_fit(lengths, np.random.default_rng(seed).permutation(300).tolist(), bins, 4096)
        people.append(bins)
    child = packing.crossover(rng, lengths, people[0], people[1], 4096)
    assert sorted(x for b in child for x in b) == list(range(300))
    assert all(lengths[b].sum() <= 4096 for b in child)


def test_warc_round_trip(spark):
    data = [(1, "u", "a\r\n\r\nb"), (2, None, "a\r\n\r\nb"), (3, "x", None), (None, "q", "WARC/1.1\r\n"), (4, "y\nz", ""), (4, "y", "")]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.page_captures(df).collect())
    assert got == [
        ("1", 6, "revisit", 2),
        ("2", 6, "response", None),
        ("3", 0, "revisit", 4),
        ("4", 0, "response", None),
        ("4", 0, "revisit", 4),
        ("None", 10, "response", None),
    ]
    empty = spark.createDataFrame([], df.schema)
    assert warc.page_captures(empty).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)]
    data += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (303, data[5][1]), (None, data[5][1]), (304, [0.5] * 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    numbers = {}
    for r in df.collect():
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v):
            numbers[r.vec_id] = [int(np.floor(256 * x)) for x in v]
    want = []
    for q in (x for x in numbers if x % 50 == 0):
        scores = [(-sum(a * b for a, b in zip(numbers[q], v, strict=True)), i) for i, v in numbers.items() if i != q and len(v) == len(numbers[q])]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:5])]
    got = vector_search.top_k(df, bits=3)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)
    assert vector_search.top_k(df.limit(0)).count() == 0


def test_tool_calls(spark):
    calls = [
        (1, 3, "c", "lookup", '{"query": "z", "b": [1.5, {"y": "é", "x": null}]}', ["b"]),
        (1, 1, "a", "search", '{"top": 3, "query": "q"}', []),
        (1, 2, "b", "search", '{"top": 0, "query": "q"}', ["a", "gone"]),
        (1, 4, "d", "none", "{", None),
        (2, 1, "e", "lookup", '{"query": "1"}', ["f"]),
        (2, 2, "f", "lookup", '{"query": "2"}', ["e"]),
        (2, 3, None, "lookup", "{}", []),
        (1, 9, "a", "search", "{}", []),
    ]
    schema = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>"
    results = spark.createDataFrame([("a", 2, "first"), ("a", 5, "later"), ("zz", 1, "lost")], "call_id string, turn long, content string")
    got = {r.call_id: r for r in tool_calls.link(spark.createDataFrame(calls, schema), results).collect()}
    assert {k: (r.level, r.status) for k, r in got.items()} == {
        "a": (0, "ok"),
        "b": (1, "invalid"),
        "c": (2, "no result"),
        "d": (0, "unknown tool"),
        "e": (None, "cycle"),
        "f": (None, "cycle"),
    }
    assert got["a"].canonical == '{"arguments":{"query":"q","top":3},"id":"a","name":"search","result":"first"}'
    assert json.loads(got["c"].canonical)["arguments"]["b"] == [1.5, {"x": None, "y": "é"}]


def test_weak_labels(spark, none):
    rng = random.Random(2)
    good = [" ".join(f"word{rng.randrange(900)}" if i % 7 else "end." for i in range(80)).replace("0", "o").replace("1", "i") for _ in range(160)]
    good = ["".join(c if not c.isdigit() else "abcdefghij"[int(c)] for c in t) for t in good]
    bad = ["spam spam " * 60] * 10 + ["THE END!! " * 40] * 10 + [" | ".join(["cell"] * 60)] * 10
    df = spark.createDataFrame(rows(good + bad + ["", None]), DOCS)
    got = {r.doc_id: r for r in weak_quality.score(df).collect()}
    assert sum(got[i].kept for i in range(160)) >= 158
    assert sum(got[i].kept for i in range(160, 190)) <= 2
    assert weak_quality.score(none).count() == 0
    assert weak_quality.keep_good(df).columns == df.columns


def test_decoding(spark):
    text = "you are an idiot and a loser or a moron so stupid and pathetic says nobody here at all " * 20
    costs = toxicity.language_model(spark.createDataFrame([(text,)], "text string"))
    got = {w: toxicity.decode(w, costs) for w in ("1d10t", "l0$er", "m-o-r-o-n", "stuuupid", "p@thetic")}
    assert got == {"1d10t": "idiot", "l0$er": "loser", "m-o-r-o-n": "moron", "stuuupid": "stupid", "p@thetic": "pathetic"}
    assert toxicity.restored("A L0$ER in 1999", costs) == "a loser in 1999"


@pytest.fixture(scope="module")
def letter_costs(spark):
    text = "i hate you such an idiot and a loser or a moron so stupid and pathetic says nobody here at all " * 20
    return toxicity.language_model(spark.createDataFrame([(text,)], "text string"))


def test_every_form_enters_the_lattice(letter_costs):
    forms = {
        "idiot": ["1 d 1 o t", "i  d  i  o  t", "idio7", "i,d,i,o,t", "i'd'i'o't", "id-io-t", "iiddiioott"],
        "moron": ["m 0 r o n", "mmoorroonn", "m.o.r.o.n"],
        "loser": ["l o s 3 r", "l0$er!"],
        "stupid": ["st-up-id", "sstuppid", "stuppid"],
    }
    for word, written in forms.items():
        for form in written:
            assert word in toxicity.restored(f"nobody {form} here", letter_costs).split(), form
    assert "worthless" in toxicity.restored("worthless", letter_costs).split()


def test_long_runs_are_decoded(letter_costs):
    text = " ".join("pathetic" * 20_000)
    assert toxicity.restored(text, letter_costs).split()[:20_000] == ["pathetic"] * 20_000


def test_features_of_short_texts(monkeypatch):
    monkeypatch.setattr("jobmill.llm.hashing._UP", np.ones(1, np.uint64))
    assert len(toxicity.text_features(["one"])[0]) == 1


def test_breaks_inside_spaced_runs(letter_costs):
    for text, words in (
        ("such a m o r o n", {"such", "a", "moron"}),
        ("s t u p i d m o r o n", {"stupid", "moron"}),
        ("i h a t e you", {"i", "hate", "you"}),
    ):
        assert words <= set(toxicity.restored(text, letter_costs).split()), text


def test_toxicity_on_held_out_rows(spark, folder):
    folder = folder.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out")
    found = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert found.get((1, 1), 0) >= 0.75 * (found.get((1, 1), 0) + found.get((1, 0), 0))
    assert found.get((0, 1), 0) <= 0.02 * found[(0, 0)]


def test_toxicity_without_labels(docs, none):
    labels = none.selectExpr("doc_id", "1 AS toxic")
    assert toxicity.score(docs, labels).where("score <> 0 OR predicted <> 0").count() == 0
    assert toxicity.score(none, labels).count() == 0


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(out.columns)
    assert 0 < out.select("doc_id").distinct().count() <= docs.count()


def test_viterbi_equals_an_exhaustive_search(letter_costs):
    from itertools import product

    rng = random.Random(8)
    seen = 0
    for _ in range(400):
        word = "".join(rng.choices("aelost013@$!.- ", k=rng.randrange(1, 8)))
        for breaks in (True, False):
            best = None
            for path in product(*toxicity.lattice(word, breaks)):
                state, total = 0, 0.0
                for _read, more, codes in path:
                    total += more
                    for code in codes:
                        total += letter_costs[state << 6 | code]
                        state = (state & 63) << 6 | code if code else 0
                total += letter_costs[state << 6]
                read = "".join(p[0] for p in path)
                best = min(best or (total, read), (total, read))
                seen += 1
            got = toxicity.decode(word, letter_costs, breaks)
            same = [p for p in product(*toxicity.lattice(word, breaks)) if "".join(x[0] for x in p) == got]
            assert got == best[1] or same, word
            if got != best[1]:  # only where two readings cost the same
                costs = []
                for path in same:
                    state, total = 0, 0.0
                    for _read, more, codes in path:
                        total += more
                        for code in codes:
                            total += letter_costs[state << 6 | code]
                            state = (state & 63) << 6 | code if code else 0
                    costs.append(total + letter_costs[state << 6])
                assert min(costs) == pytest.approx(best[0], abs=1e-9)
    assert seen > 5000


def test_reader_equals_whole_texts(letter_costs):
    rng = random.Random(9)
    parts = ["m o r o n", "m.o.r.o.n", "l0ser", "paththetic", "worthless", "a", "of", "sstupid", "st-up-id", "the", "\n", "i d i o t", "-", "x!"]
    texts = ["", " ", *(" ".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(200))]
    features = [(0, b"moron"), (0, b"loser"), (4, b"path"), (0, b"pathetic"), (0, b"stupid"), (5, b"worth"), (0, b"idiot")]
    hashes = toxicity.feature_hashes(features)
    order = np.argsort(hashes)
    features = [features[i] for i in order]
    for budget in (1 << 30, 2000):
        reader = toxicity.Reader(letter_costs, hashes[order], toxicity.Wanted(features), budget)
        got = [h for i in range(0, len(texts), 16) for h in reader.hits(texts[i : i + 16])]
        for text, hits in zip(texts, got, strict=True):
            # A word of a longer run is read alone as well.
            own = toxicity.word_features(toxicity.restored(text, letter_costs)) & set(features)
            alone = set().union(*(toxicity.word_features(toxicity.restored(w, letter_costs)) for w in text.split()))
            assert own <= {features[i] for i in hits} <= own | alone, text
    both = toxicity.text_features(["Worthless idiot", "", "x"])
    assert set(both[0][both[1] == 0]) == set(toxicity.feature_hashes(list(toxicity.word_features("Worthless idiot"))))
