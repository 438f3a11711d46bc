"""Toxicity of whole texts: obfuscated words are decoded by Viterbi search over character
lattices under a character language model, then the restored text is scored."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmill.llm.common import drop, store
from jobmill.llm.hashing import BASE, joined_hashes, mix64, tables

PREDICT_AT = 0.3
#: Labelled ids that the model is fitted on, about.
LABELLED = 40_000
#: Toxic training rows that candidate features come from, about, chosen by a hash.
TOXIC_ROWS = 20_000
#: Documents of the base rate added to a feature's counts, first and last.
DOUBT, LAST_DOUBT = 20.0, 4.0
LEAST_SHARE = 0.2
PREFIXES = (4, 5, 6)
# What a sign can stand for in place of letters.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
SEPARATORS = " .-_*,'"
# Signs that also part words, as punctuation does.
PUNCTUATION = "!|+("
#: Costs (negative log chances) of the channel. A gap costs once for each sign of it.
LEET_COST, DROP_COST, GAP_COST, RUN_COST, DOUBLE_COST = 1.0, 7.0, 0.3, 0.3, 0.7
BREAK_COST, KEEP_COST, PAIR_COST = 0.7, 5.0, 1.5
#: Texts read together, characters counted together, bytes of words that a task remembers.
TEXTS_AT_ONCE, AT_ONCE, REMEMBERED_BYTES = 128, 1 << 20, 48 << 20
# What the lattice has more than one reading of: parts of one or two characters with any
# separators between, words with signs among, before or after letters, and words with a letter
# twice or more in a row. Every alternative begins at a word's first sign only and gives nothing
# back, so long runs are looked at once.
CHARS = "0-9a-z\u00df-\u00f6\u00f8-\u00ff@$!|+("
SPACED_RUN = r"(?<![\w@$!|+(])[CHARS]{1,2}+(?:[ .\-_*,']++[CHARS]{1,2}+(?![CHARS])){2,}+".replace("CHARS", CHARS)
SPACED = re.compile(SPACED_RUN)
NOISY = re.compile(
    SPACED_RUN
    + r"|(?<![\w@$!|+(])(?:[^\W\d_]++[0-9@$!|+(]|[0-9@$!|+(]++[^\W\d_])[@$!|+(\w]*+"
    + r"|(?<!\w)[^\W\d_]*?([^\W\d_])\1\w*+"
)
# A word that may be part of a run over several words: its first or last part is short, or it
# is all separators.
SHORT = re.compile(r"^[^CHARS]*[CHARS]{1,2}(?![CHARS])|(?<![CHARS])[CHARS]{1,2}[^CHARS]*$|^[.\-_*,']+$".replace("CHARS", CHARS))
ALPHABET = 64


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Letter classes of Latin-1 bytes: 1-26, other letters 27-63, everything else 0."""
    out = np.zeros(256, np.int64)
    out[97:123] = np.arange(1, 27)
    out[0xDF:0x100] = 27 + np.arange(33)
    out[0xD7] = out[0xF7] = 0
    out[ord("?")] = 0
    return out


def letters(text: str) -> np.ndarray:
    return classes()[np.frombuffer(text.lower().encode("latin-1", "replace"), np.uint8)]


def trigram_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of letter trigrams of all texts of a task; a word begins after two breaks."""
    total = np.zeros(ALPHABET**3, np.int64)

    def count(parts: list[np.ndarray]) -> None:
        c = np.concatenate(parts)
        a = np.concatenate([[0, 0], c, [0]])
        first = np.where(a[1:-1] == 0, 0, a[:-2])
        total[:] += np.bincount((first * ALPHABET + a[1:-1]) * ALPHABET + a[2:], minlength=ALPHABET**3)

    end = np.zeros(1, np.int64)
    for batch in batches:
        parts, held = [], 0
        for text in batch["text"]:
            if isinstance(text, str) and text:
                parts += [letters(text), end]
                held += len(text)
                if held > AT_ONCE:
                    count(parts)
                    parts, held = [], 0
        if parts:
            count(parts)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"gram": at, "n": total[at]})


def language_model(docs: DataFrame) -> array:
    """Costs of a letter after two others, from the counts over all documents.

    Counts are summed by trigram, of which there are 64^3, whatever the data.
    """
    grams = docs.select("text").mapInPandas(trigram_batches, "gram long, n long")
    found = grams.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(ALPHABET**3)
    counts[found["gram"].to_numpy()] = found["n"]
    counts = counts.reshape(ALPHABET, ALPHABET, ALPHABET)
    two = counts.sum(0) + 0.5
    two /= two.sum(1, keepdims=True)
    three = (counts + 20 * two[None]) / (counts.sum(2, keepdims=True) + 20)
    return array("d", -np.log(three).ravel())


@lru_cache(maxsize=4096)
def choices(c: str, n: int, breaks: bool = True) -> list[tuple[str, float, tuple[int, ...]]]:
    """What a run of ``n`` times one character can stand for, the cost of each and its codes."""
    if c in SEPARATORS:
        out = [("", GAP_COST * n), (" ", BREAK_COST)][: 1 + breaks]
    elif c in LEET:
        reads = [(x, LEET_COST) for x in LEET[c]]
        reads += [(x * 2, cost) for x, cost in reads if n > 1]
        plain = (" ", BREAK_COST) if c in PUNCTUATION else (c * n, KEEP_COST)
        out = reads + [("", DROP_COST), plain]
    elif n == 1:
        out = [(c, 0.0)]
    elif n == 2:
        out = [(c * 2, 0.0), (c, PAIR_COST)]
    else:
        out = [(c, RUN_COST), (c * 2, DOUBLE_COST)]
    table = classes()
    return [(read, cost, tuple(int(table[ord(x)]) if ord(x) < 256 else 0 for x in read)) for read, cost in out]


RUN = re.compile(r"(.)\1*")


def lattice(word: str, breaks: bool = True) -> list[list[tuple[str, float, tuple[int, ...]]]]:
    """For every run of one character what it can stand for."""
    return [choices(m[1], m.end() - m.start(), breaks) for m in RUN.finditer(word)]


def decode(word: str, costs: array, breaks: bool = True) -> str:
    """The cheapest reading of a lower-case word: channel costs plus the model's.

    A state is the last two letters' codes. A break makes the next letter a word's first;
    without ``breaks`` separators only join. Work grows with the length of the word.
    """
    best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for step in lattice(word, breaks):
        after: dict[int, tuple[float, tuple | None]] = {}
        for before, (cost, path) in best.items():
            for read, more, codes in step:
                state, total = before, cost + more
                for code in codes:
                    total += costs[state << 6 | code]
                    state = (state & 63) << 6 | code if code else 0
                if state not in after or total < after[state][0]:
                    after[state] = (total, (path, read) if read else path)
        best = after
    path = min(((cost + costs[state << 6], i, path) for i, (state, (cost, path)) in enumerate(best.items())))[2]
    out = []
    while path:
        path, read = path
        out.append(read)
    return "".join(reversed(out))


def readings(word: str, costs: array) -> str:
    """What stands for an obfuscated word: a run of parts with the breaks that the model chooses
    and as one word, a word without signs or separators also as written."""
    out = [decode(word, costs)]
    if word.isalpha():
        out.append(word)
    elif any(c in SEPARATORS for c in word):
        out.append(decode(word, costs, breaks=False))
    return " ".join(dict.fromkeys(out))


def skeleton(word: str) -> str:
    """The word with one character for every run of it."""
    return RUN.sub(r"\1", word)


class Wanted:
    """Which plain words can be read as one that some feature begins, by their skeletons.

    All readings of a word of letters alone have its skeleton, so where no feature's skeleton
    fits, no reading has the feature, and the word need not be decoded.
    """

    def __init__(self, features: list[tuple[int, bytes]]) -> None:
        self.whole = {skeleton(word.decode(errors="ignore")) for n, word in features if not n}
        self.first = {skeleton(word.decode(errors="ignore")) for n, word in features if n}

    def __contains__(self, word: str) -> bool:
        own = skeleton(word)
        return own in self.whole or any(own[:n] in self.first for n in range(1, max(PREFIXES) + 1))


def restored(text: str, costs: array, wanted: Wanted | None = None, known: dict[str, str] | None = None) -> str:
    """The lower-cased text with the readings of every obfuscated word in its place.

    With ``wanted``, plain words that can't have a wanted feature stay as written.
    """
    known = {} if known is None else known

    def read(m: re.Match) -> str:
        word = m[0]
        found = known.get(word)
        if found is None:
            if word.isalpha():
                found = readings(word, costs) if wanted is None or word in wanted else word
            else:
                found = readings(word, costs) if any(c.isalpha() for c in word) else word
            known[word] = found
        return found

    return NOISY.sub(read, text.lower())


# Every ASCII character that is no letter or digit parts words.
PARTS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and of the first 4, 5 and 6 bytes of longer ones, and each one's text."""
    coded = [t.encode() for t in texts]
    data = b"\n".join(coded).translate(PARTS)
    if not data.strip():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole, start = joined_hashes(data)
    raw = np.frombuffer(data, np.uint8)
    blank = np.append(np.flatnonzero(raw == 32), len(raw))
    length = blank[np.searchsorted(blank, start)] - start
    firsts = np.cumsum([0, *(len(c) + 1 for c in coded[:-1])])
    owner = np.searchsorted(firsts, start, "right") - 1
    up, _ = tables(max(PREFIXES) + 1)
    out, owners = [whole], [owner]
    with np.errstate(over="ignore"):
        for n in PREFIXES:
            some = length > n
            at = start[some]
            value = np.zeros(len(at), np.uint64)
            for i in range(n):
                value += (raw[at + i].astype(np.uint64) + np.uint64(1)) * up[i]
            out.append(mix64(value ^ np.uint64(n * 0x9E3779B9)))
            owners.append(owner[some])
    return np.concatenate(out), np.concatenate(owners)


def word_features(text: str) -> set[tuple[int, bytes]]:
    """The same features of a single text in plain form: ``(0, word)`` and ``(n, first n bytes)``."""
    words = set(text.encode().translate(PARTS).split())
    return {(0, w) for w in words} | {(n, w[:n]) for w in words for n in PREFIXES if len(w) > n}


def feature_hashes(features: list[tuple[int, bytes]]) -> np.ndarray:
    """Hashes of features in plain form, as ``text_features`` gives them."""
    out = np.zeros(len(features), np.uint64)
    for i, (n, word) in enumerate(features):
        if n:
            value = sum((b + 1) * pow(BASE, j, 1 << 64) for j, b in enumerate(word)) % (1 << 64)
            out[i] = mix64(np.array([value ^ (n * 0x9E3779B9)], np.uint64))[0]
        else:
            out[i] = joined_hashes(word)[0][0]
    return out


def lines(text: str) -> str:
    """The text with a sign of its own at every blank that is no space: runs don't go over them."""
    for blank in "\t\n\v\f\r":
        text = text.replace(blank, " \0 ")
    return text


class Reader:
    """Which of the sorted feature hashes ``keys`` texts have after restoring, by their distinct words.

    A word is restored and looked up once and its hits are remembered. Words that begin or end
    in a part of one or two characters may belong to a run over several words, so two or
    more of them in a row are read once more together, with their neighbours. So each word is
    also read alone, and a text has all hits of its whole restored form or more.
    """

    def __init__(self, costs: array, keys: np.ndarray, wanted: Wanted | None = None, budget: int = REMEMBERED_BYTES) -> None:
        self.costs, self.keys, self.wanted, self.budget = costs, keys, wanted, budget
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}  # place in ``found`` times two, plus one if short
        self.runs: dict[str, int] = {}
        self.read: dict[str, str] = {}
        self.found: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.held = 0

    def look_up(self, texts: list[str]) -> list[int]:
        """Restore texts and give the place in ``found`` of each one's hits; 0 for none."""
        at = [0] * len(texts)
        if not len(self.keys):
            return at
        hashes, owner = text_features([restored(t, self.costs, self.wanted, self.read) for t in texts])
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = self.keys[place] == hashes
        order = np.lexsort((place[hit], owner[hit]))
        place, owner = place[hit][order], owner[hit][order]
        own, first = np.unique(owner, return_index=True)
        for i, hits in zip(own.tolist(), np.split(place, first[1:]), strict=False):
            at[i] = len(self.found)
            self.found.append(np.unique(hits))
        return at

    def hits(self, texts: list[str]) -> list[np.ndarray]:
        """For every text the sorted places of its features among ``keys``."""
        split = [lines(t.lower()).split() for t in texts]
        every = set(chain.from_iterable(split))
        missing = list(every.difference(self.words))
        self.held += sum(map(len, missing)) + 200 * len(missing)
        if self.held > self.budget:
            self.forget()
            missing = list(every)
        for word, at in zip(missing, self.look_up(missing), strict=True):
            self.words[word] = 2 * at + (SHORT.search(word) is not None)
        seen, wanted = [], []
        for words in split:
            code = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            seen.append(np.unique(code >> 1).tolist())
            edge = np.diff(np.concatenate([[0], code & 1, [0]]))
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            several = end - begin > 1
            found = [" ".join(words[max(0, a - 1) : b + 1]) for a, b in zip(begin[several].tolist(), end[several].tolist(), strict=True)]
            wanted.append([r for r in found if SPACED.search(r)])
        new = list(set(chain.from_iterable(wanted)).difference(self.runs))
        self.held += sum(map(len, new)) + 200 * len(new)
        self.runs.update(zip(new, self.look_up(new), strict=True))
        out = []
        for own, runs in zip(seen, wanted, strict=True):
            places = [i for i in {*own, *(self.runs[r] for r in runs)} if i]
            out.append(np.unique(np.concatenate([self.found[i] for i in places])) if places else self.found[0])
        return out


def texts_of(column: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


def toxic_features(costs):
    """A function that sums, per task, the documents by feature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter(chain.from_iterable(word_features(restored(t, costs.value)) for t in texts_of(batch["text"])))
            if found:
                plain = list(found)
                yield pd.DataFrame({"first": [f[0] for f in plain], "word": [f[1] for f in plain], "n": list(found.values())})

    return run


def count_batches(costs, model, best: bool):
    """A function that sums, per task, the documents with and without the mark by the model's features.

    With ``best``, a document counts only for its feature of the greatest share.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, share, wanted = model.value
        reader = Reader(costs.value, keys, wanted)
        counts = np.zeros((2, len(keys)), np.int64)
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[at : at + TEXTS_AT_ONCE]
                for hits, toxic in zip(reader.hits(texts_of(part["text"])), part["toxic"], strict=True):
                    if best and len(hits):
                        hits = hits[[int(share[hits].argmax())]]
                    counts[int(toxic > 0), hits] += 1
        some = np.flatnonzero(counts.any(axis=0))
        yield pd.DataFrame({"feature": some, "bad": counts[1, some], "fine": counts[0, some]})

    return run


def train_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts that are not held out, of about ``LABELLED`` labelled ids chosen by a hash.

    So few ids may be broadcast, and no text is moved. Ids labelled twice count as toxic if
    one row says so.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("labelled")), F.lit(1 << 30))
    marks = marks.where(part < int(min(1.0, LABELLED / max(1, marks.count())) * (1 << 30)))
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return docs.where(~held_out()).select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, costs) -> tuple[np.ndarray, np.ndarray, Wanted]:
    """Sorted features, each one's estimated share of toxic documents, and words that may have them.

    The candidates are the features that two or more of about ``TOXIC_ROWS`` toxic training
    rows have, so their number is bounded by these rows. They are then counted over all
    training rows, with ``DOUBT`` documents of the base rate added. Rare words of a copied
    toxic text look toxic as well; so the toxic rows are counted again, each only for its
    feature of the greatest share, and features that explain none go.
    """
    train = store(train_rows(docs, labels), "train")
    total, toxic = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = (toxic + 0.5) / (total + 1)
    share_of_rows = min(1.0, TOXIC_ROWS / max(1, toxic))
    chosen = F.pmod(F.xxhash64("text", F.lit("toxic")), F.lit(1 << 20)) < int(share_of_rows * (1 << 20))
    marked = train.where("toxic > 0")
    candidates = (
        marked.where(chosen)
        .select("text")
        .mapInPandas(toxic_features(costs), "first int, word binary, n long")
        .groupBy("first", "word")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .collect()
    )
    features = [(r["first"], bytes(r["word"])) for r in candidates]
    keys = feature_hashes(features)
    order = np.argsort(keys)
    keys, features = keys[order], [features[i] for i in order]

    def counted(rows: DataFrame, share: np.ndarray, best: bool) -> tuple[np.ndarray, np.ndarray]:
        model = docs.sparkSession.sparkContext.broadcast((keys, share, Wanted(features)))
        found = rows.mapInPandas(count_batches(costs, model, best), "feature long, bad long, fine long")
        sums = found.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine")).toPandas()
        out = np.zeros((2, len(keys)))
        out[:, sums["feature"].to_numpy(np.int64)] = sums[["bad", "fine"]].to_numpy().T
        return out[0], out[1]

    bad, fine = counted(train, np.zeros(len(keys)), False)
    share = (bad + DOUBT * base) / (bad + fine + DOUBT)
    kept = (bad > 1) & (share >= LEAST_SHARE)
    keys, share, fine, features = keys[kept], share[kept], fine[kept], list(compress(features, kept))
    bad, _ = counted(marked, share, True)
    drop(train)
    share = (bad + LAST_DOUBT * base) / (bad + fine + LAST_DOUBT)
    kept = (bad > 0) & (share >= LEAST_SHARE)
    return keys[kept], share[kept], Wanted(list(compress(features, kept)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Learned from the labelled documents whose ``crc32(doc_id)`` modulo 4 is not 2 and from
    the letters of all documents. A text's score is the greatest share of its features, the
    base score 0 if it has none, as null and empty texts do. A null id is not held out.
    Without labels all scores are 0. Extra columns take no part.
    """
    spark = docs.sparkSession
    costs = spark.sparkContext.broadcast(language_model(docs))
    model = spark.sparkContext.broadcast(learn(docs, labels, costs))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keys, share, wanted = model.value
        reader = Reader(costs.value, keys, wanted)
        for texts in batches:
            out = []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                found = reader.hits(texts_of(texts.iloc[at : at + TEXTS_AT_ONCE]))
                out += [float(share[hits].max()) if len(hits) else 0.0 for hits in found]
            yield pd.Series(out, dtype=float)

    scored = docs.select("doc_id", held_out().alias("held_out"), run("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= PREDICT_AT).cast("int"))
