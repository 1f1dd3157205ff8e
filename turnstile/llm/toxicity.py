"""Toxicity of texts whose words may be disguised: a noisy channel in front of a word model.

A disguised span (symbols for letters, letters or pieces set apart, letters repeated) is a
lattice: each character may stand for itself or for letters it resembles, a run may
stand for one or two letters, a separator may be nothing or a space. Viterbi search
under a character trigram model picks the likeliest reading. The model comes from
the words of all documents, counted by Spark. The restored words are then scored.

Spark finds the spans that may be disguised, and each distinct one is decoded once. The
trigrams stay a table: spans are dealt to buckets of some ``BUCKET_SPANS``, the trigrams that a
bucket's lattices can ask for are joined with their costs, and a task holds one bucket of both.

The score is learnt from labelled texts: words, and beginnings of words, are either
toxic or not, and how many of their texts are toxic tells which; the share of toxic
ones is itself fitted, so that chance finds among many words count little. A text's score is the chance that at least one of its distinct words means
what its value says. A word counts once for each pair of neighbours it is seen with,
so copies of a text, and passages that many texts share, count once.

At most ``FIT_ROWS`` labelled texts, drawn by hash, are used to fit the scorer
(a documented bound of the classifier), so the features that travel to the tasks are of so many texts at most.

Defined results: a NULL or empty text gets the score of a text without evidence;
repeated rows get the same score and are kept or dropped together; rows without a label, or with a NULL one, are not
learnt from; without any labels all texts get the score 0. Spans of any length are
decoded whole. Other columns are carried as they are, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.texts import whole
from turnstile.session import scratch_path, written_copy

FIT_ROWS = 10_000
BEGINNINGS = range(4, 8)  # letters of a word's beginning that make a feature
HIT = 0.98  # share of toxic texts among those with a toxic word
SPREADS = (2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 1e4)
EVIDENCE = 0.6  # a feature below this is more likely a chance find, and is left out
CACHED = 50_000
LETTER_BITS = 21

# What a symbol or digit may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
SWAP, DROP, SHRINK, UNKNOWN = 1.0, 0.3, 0.5, 12.0  # costs in nats
SEPARATOR = " .-_*"
BUCKET_SPANS = 4096
BATCH_TEXTS = 500  # texts that a Python worker holds at once

WORD = re.compile(r"[^\W\d_]+")
# Single characters set apart by white space, and marks of a disguise within a token: characters or pieces between
# separators, a symbol beside a letter, one letter three times. What such a span says is left to the decoder.
_LETTER, _BREAK = r"[^\W\d_]", r"[.\-_*]+"
_SYMBOLS = re.escape("".join(LOOKS_LIKE))
SPACED = re.compile(r"(?<!\S)(?:\S\s{1,2}){2,}\S(?!\S)")
DISGUISED = re.compile(
    rf"^\W*(?:[^\W_]{_BREAK}){{2,}}[^\W_]\W*$|{_LETTER}{_BREAK}{_LETTER}|[{_SYMBOLS}]{_LETTER}|{_LETTER}[@$!|+(€£0-9]"
)
TRIPLED = re.compile(rf"({_LETTER})\1\1")
PLAIN_ENDS = ".,;:?\"'"  # what may stand beside a word without disguising it


class Costs:
    """Costs by code, found by bisection in sorted arrays."""

    def __init__(self, codes: np.ndarray, costs: np.ndarray):
        self.codes, self.costs = codes, costs

    def get(self, code: int) -> float | None:
        at = bisect_left(self.codes, code)
        return float(self.costs[at]) if at < len(self.codes) and self.codes[at] == code else None


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes, the sum of the counts of each, and where each given code is."""
    found, place = np.unique(codes, return_inverse=True)
    return found, np.bincount(place, counts, len(found)), place


class CharacterModel:
    """Costs of a letter after two others, backed off to fewer; ' ' ends and begins words.

    Letters are codes of ``LETTER_BITS``, the first of a gram highest. Costs once
    asked for are kept in a dictionary.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """From all trigrams and how often each occurs, by absolute discounting."""
        order = np.argsort(codes)
        codes, counts = np.asarray(codes, np.int64)[order], np.asarray(counts, np.float64)[order]
        letter = (1 << LETTER_BITS) - 1
        _, heads, head = _summed(codes >> LETTER_BITS, counts)
        pairs, pair_counts, _ = _summed(codes & ((1 << 2 * LETTER_BITS) - 1), counts)
        _, tails, tail = _summed(pairs >> LETTER_BITS, pair_counts)
        singles, single_counts, _ = _summed(pairs & letter, pair_counts)
        self.three = Costs(codes, -np.log(np.maximum(counts - 0.5, 0.5) / heads[head]))
        self.two = Costs(pairs, -np.log(np.maximum(pair_counts - 0.5, 0.5) / tails[tail]))
        self.one = Costs(singles, -np.log(single_counts / (single_counts.sum() or 1)))
        self.known: dict[str, float] = {}

    def cost(self, before: str, letter: str) -> float:
        gram = before + letter
        found = self.known.get(gram)
        if found is None:
            first, second, third = map(ord, gram)
            pair = second << LETTER_BITS | third
            found = self.three.get(first << 2 * LETTER_BITS | pair)
            if found is None:
                found = self.two.get(pair)
                if found is None:
                    found = self.one.get(third)
                    found = 2.0 + (found if found is not None else UNKNOWN)
                found += 2.0
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[gram] = found
        return found


def _readings(span: str) -> Iterator[list[tuple[str, float]]]:
    """For each run of one character: what it may stand for, with its cost. '' is nothing."""
    at = 0
    while at < len(span):
        char, end = span[at], at + 1
        while end < len(span) and span[end] == char:
            end += 1
        first, run, at = at == 0, end - at, end
        options = [("", DROP)] if first and char == "(" else []  # a bracket before a word
        if char in SEPARATOR:
            options += [("", DROP), (" ", 2 * DROP)]
        else:
            options.append((char * min(run, 2), SHRINK * (run > 2)))
            if run > 1:
                options.append((char, SHRINK))
        for letter in LOOKS_LIKE.get(char, ""):
            options.append((letter, SWAP))
            if run > 1:
                options.append((letter * 2, SWAP))
        yield options


def restore(span: str, model: CharacterModel) -> str:
    """The likeliest reading of a span: Viterbi over states of the last two letters."""
    best: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    for options in _readings(span):
        following: dict[str, tuple[float, tuple | None]] = {}
        for state, (cost, path) in best.items():
            for text, price in options:
                total, last = cost + price, state
                for letter in text:
                    total += model.cost(last, letter)
                    last = last[1] + letter
                if last not in following or total < following[last][0]:
                    following[last] = (total, (path, text) if text else path)
        best = following
    ends = ((cost + model.cost(state, " "), state, path) for state, (cost, path) in best.items())
    path = min(ends, key=lambda end: end[:2])[2]
    letters = []
    while path is not None:
        path, text = path
        letters.append(text)
    return "".join(reversed(letters))


class AskedCosts:
    """The costs of some grams."""

    def __init__(self, costs: dict[str, float]):
        self.costs = costs

    def cost(self, before: str, letter: str) -> float:
        return self.costs[before + letter]


class Asking:
    """In place of a model: notes the grams that decoding a span asks for, which do not depend on their costs."""

    def __init__(self):
        self.grams: set[str] = set()

    def cost(self, before: str, letter: str) -> float:
        self.grams.add(before + letter)
        return 0.0


def evened(span: str) -> str:
    """A span with a blank for each white space character."""
    return re.sub(r"\s", " ", span)


def contexts(text: str | None, restored: dict[str, list[str]]) -> dict[str, int]:
    """Each distinct word of a text, restored ones too, and a hash of what stands around its first occurrence."""
    low = (text or "").lower()
    tokens = ["", *low.split(), ""]
    around = [(WORD.findall(token), f"{tokens[i]} {tokens[i + 2]}") for i, token in enumerate(tokens[1:-1])]
    for span, words in restored.items():
        at = low.find(span)
        around.append((words, low[max(0, at - 20) : at] + low[at + len(span) : at + len(span) + 20] if at >= 0 else span))
    found: dict[str, int] = {}
    for words, near in around:
        for word in words:
            if word not in found:
                found[word] = zlib.crc32(near.encode())
    return found


class Telling:
    """Finds the words that speak for toxicity."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        # Words of no feature differ from all features in their first letters.
        self.starts = {feature.rstrip("*")[: BEGINNINGS[0]] for feature in weights}

    def of(self, words: set[str]) -> list[tuple[str, float]]:
        """Words with the weight of their best feature."""
        first, get = BEGINNINGS[0], self.weights.get
        near = [w for w in words if w[:first] in self.starts]
        return [(w, weight) for w in near if (weight := max(get(f, 0.0) for f in _features({w}))) > 0]


# --- spans -------------------------------------------------------------------------------------------------


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of ``BATCH_TEXTS`` rows for the tables written inside, so that workers stay small on long texts."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(BATCH_TEXTS, int(before)) if int(before) > 0 else BATCH_TEXTS))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def text_key(text: Column) -> Column:
    """What tells texts apart, 16 bytes."""
    return F.unhex(F.md5(whole(text).cast("binary")))


def spans_of(text: str | None) -> set[str]:
    """The distinct spans of a text that may be disguised, in lower case."""
    low = (text or "").lower()
    tokens = low.split()
    different = set(tokens)
    found = {t for t in different if not t.strip(PLAIN_ENDS).isalpha() and DISGUISED.search(t)}
    if TRIPLED.search(low):
        found.update(t for t in different if TRIPLED.search(t))
    if list(map(len, tokens)).count(1) > 2:
        found.update(m.group() for m in SPACED.finditer(low))
    return found


def disguised_spans(text: Column) -> Column:
    """The distinct spans of a text that may be disguised; other columns of the row stay outside Python."""

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(spans_of(t)) for t in texts])

    return found(text)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """The trigrams of all words of all documents, weighted by how often the words occur: gram, n."""
    words = F.explode(F.split(F.lower(whole(F.col("text"))), r"[^\p{L}]+")).alias("word")
    path = scratch_path(docs.sparkSession, "words")
    docs.select(words).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    padded = F.concat(F.lit("  "), "word", F.lit(" "))
    places = F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("place")
    return (
        docs.sparkSession.read.parquet(path)
        .select(padded.alias("padded"), "n", places)
        .groupBy(F.substr("padded", F.col("place"), F.lit(3)).alias("gram"))
        .agg(F.sum("n").alias("n"))
    )


def gram_costs(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """The cost of each gram's last letter after the first two, by absolute discounting, backed off to fewer letters."""
    last_two, last = F.substring("gram", 2, 2), F.substring("gram", 3, 1)
    heads = counts.groupBy(F.substring("gram", 1, 2).alias("head")).agg(F.sum("n").alias("head_n"))
    pairs = counts.groupBy(last_two.alias("pair")).agg(F.sum("n").alias("pair_n"))
    tails = pairs.groupBy(F.substring("pair", 1, 1).alias("tail")).agg(F.sum("pair_n").alias("tail_n"))
    singles = pairs.groupBy(F.substring("pair", 2, 1).alias("single")).agg(F.sum("pair_n").alias("single_n"))
    total = counts.agg(F.sum("n").alias("total"))

    def cost(n: str, of: str) -> Column:
        return F.when(F.col(n).isNotNull(), -F.log(F.greatest(F.col(n) - 0.5, F.lit(0.5)) / F.col(of)))

    keyed = grams.select(
        "gram", F.substring("gram", 1, 2).alias("head"), last_two.alias("pair"), F.substring("gram", 2, 1).alias("tail"), last.alias("single")
    )
    joined = keyed.join(counts, "gram", "left").join(heads, "head", "left").join(pairs, "pair", "left").join(tails, "tail", "left")
    joined = joined.join(singles, "single", "left").withColumn("total", total.scalar())
    alone = F.coalesce(-F.log(F.col("single_n") / F.col("total")), F.lit(UNKNOWN)) + 4.0
    return joined.select("gram", F.coalesce(cost("n", "head_n"), cost("pair_n", "tail_n") + 2.0, alone).alias("cost"))


def restored_spans(spans: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct spans with the words of their likeliest reading: span, words."""
    buckets = max(1, math.ceil(spans.count() / BUCKET_SPANS))
    placed = spans.select("span", F.pmod(F.xxhash64("span"), F.lit(buckets)).alias("bucket"))

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bucket, held in frame.groupby("bucket")["span"]:
                asking = Asking()
                for span in held:
                    restore(evened(span), asking)
                yield pd.DataFrame({"bucket": bucket, "gram": sorted(asking.grams)})

    wanted = written_copy(placed.repartition("bucket").mapInPandas(asked, "bucket long, gram string").distinct(), "asked")
    known = wanted.join(gram_costs(wanted.select("gram").distinct(), counts), "gram")

    def decoded(held: pd.DataFrame, costs: pd.DataFrame) -> pd.DataFrame:
        model = AskedCosts(dict(zip(costs["gram"], costs["cost"], strict=True)))
        return pd.DataFrame({"span": held["span"], "words": [WORD.findall(restore(evened(span), model)) for span in held["span"]]})

    both = placed.groupBy("bucket").cogroup(known.groupBy("bucket"))
    return both.applyInPandas(decoded, "span string, words array<string>")


def character_model(docs: DataFrame) -> CharacterModel:
    """All trigrams of a corpus as one model on the driver, 16 bytes each: for corpora known to be small, and for comparison."""
    code = F.lit(0).cast("long")
    for place in (1, 2, 3):
        code = F.shiftleft(code, LETTER_BITS).bitwiseOR(F.ascii(F.substring("gram", place, 1)).cast("long"))
    grams = trigram_counts(docs).select(code.alias("code"), "n").toArrow()
    return CharacterModel(grams["code"].to_numpy(), grams["n"].to_numpy())


def _features(words: set[str]) -> set[str]:
    """Each word, and its beginnings marked by a star."""
    found = set(words)
    for word in words:
        found.update(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)
    return found


def toxic_chances(seen: list[tuple[int, int, int]]) -> dict[tuple[int, int], float]:
    """For features seen n times, k of them in toxic texts: the chance that they are toxic words, times HIT.

    ``seen`` says that m features have n and k. A toxic word's texts are toxic with the
    fixed chance HIT; any other feature has a toxic share of its own, beta distributed
    around the common one. How many features are toxic, and how far the shares of the
    others spread, is fitted: expectation maximisation for each of SPREADS, the likeliest kept.
    """
    base = sum(k * m for _, k, m in seen) / max(1, sum(n * m for n, _, m in seen))
    base = min(max(base, 1e-4), 0.5)
    total = max(1, sum(m for *_, m in seen))
    best: tuple[float, dict[tuple[int, int], float]] = (-math.inf, {})

    def beta(x: float, y: float) -> float:
        return math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)

    for spread in SPREADS:
        a, b = base * spread, (1 - base) * spread
        other = {(n, k): beta(a + k, b + n - k) - beta(a, b) for n, k, _ in seen}
        toxic = {(n, k): k * math.log(HIT) + (n - k) * math.log(1 - HIT) for n, k, _ in seen}
        share = 1e-3
        for _ in range(40):
            odds = {p: math.exp(min(50.0, toxic[p] - other[p])) * share / (1 - share) for p in other}
            share = sum(m * odds[n, k] / (1 + odds[n, k]) for n, k, m in seen) / total
            share = min(max(share, 1e-6), 0.5)
        fit_of = sum(m * (other[n, k] + math.log(1 - share) + math.log1p(odds[n, k])) for n, k, m in seen)
        if fit_of > best[0]:
            best = (fit_of, {p: HIT * o / (1 + o) for p, o in odds.items()})
    return best[1]


def fit(labelled: DataFrame, restored: DataFrame, rows: int = FIT_ROWS) -> dict[str, float]:
    """Features and the toxic share they speak for, from (doc_id, text, toxic) and the restored spans (span, words)."""
    spark = labelled.sparkSession
    total = labelled.count()
    drawn = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < math.ceil(min(1.0, rows / max(total, 1)) * (1 << 20))
    words = F.split(whole(F.col("text")), r"[^\p{L}]+")
    copies = F.array_min(F.transform(words, lambda w: F.xxhash64(F.lower(w)))).alias("copies")
    learnt = labelled.where(drawn).select(copies, "text", F.col("toxic").cast("int").alias("toxic"), text_key(F.col("text")).alias("key"))
    # Copies of a text are one row from here on, folded in each input task.
    learnt = learnt.groupBy("copies", "key").agg(F.first("text").alias("text"), F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("texts"))
    learnt = written_copy(learnt, "learnt")
    spans = learnt.select("key", F.explode(disguised_spans(F.col("text"))).alias("span")).distinct()
    said = spans.join(restored, "span").groupBy("key").agg(F.collect_list(F.struct("span", "words")).alias("said"))

    def spelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            features, around = [], []
            for text, said in zip(frame["text"], frame["said"], strict=True):
                first: dict[str, int] = {}
                spans = {} if said is None else {s["span"]: list(s["words"]) for s in said}
                for word, context in contexts(text, dict(sorted(spans.items()))).items():
                    for feature in _features({word}):
                        first.setdefault(feature, context)
                features.append(list(first))
                around.append(list(first.values()))
            yield frame[["copies", "toxic", "texts"]].assign(feature=features, context=around)

    path = scratch_path(spark, "toxic-features")
    read = learnt.join(said, "key", "left").select("copies", "text", "toxic", "texts", "said")
    met = read.mapInPandas(spelled, "copies long, toxic long, texts long, feature array<string>, context array<long>").select(
        "copies", "toxic", "texts", F.explode(F.arrays_zip("feature", "context")).alias("seen")
    )
    # copies with the same smallest word count once, and so do those that escape this but share the neighbours;
    # such a group is toxic if most of its texts are, so a passage of many clean texts and a few toxic ones is not
    once = met.groupBy("seen.feature", "copies").agg(
        F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts"), F.min("seen.context").alias("context")
    )
    once = once.groupBy("feature", "context").agg((2 * F.sum("toxic") > F.sum("texts")).cast("int").alias("toxic"))
    once.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).where("n > 1").write.parquet(path)
    counted = spark.read.parquet(path).where("feature <> ''")
    seen = counted.groupBy("n", "k").agg(F.count(F.lit(1)).alias("m"))
    chances = toxic_chances([(r["n"], r["k"], r["m"]) for r in seen.collect()])  # fewer rows than texts learnt from
    telling = [(n, k, weight) for (n, k), weight in chances.items() if weight >= EVIDENCE]
    if not telling:
        return {}
    table = F.broadcast(spark.createDataFrame(telling, "n long, k long, weight double"))
    kept = counted.join(table, ["n", "k"]).select("feature", "weight")
    return {r["feature"]: r["weight"] for r in kept.collect()}  # of at most FIT_ROWS texts


_EVIDENCE = "array<struct<word: string, weight: double>>"


def telling_words(text: Column, weights: dict[str, float]) -> Column:
    """The plain words of a text that speak for toxicity, with their weights; other columns of the row stay outside Python."""

    @F.pandas_udf(_EVIDENCE)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        telling = Telling(weights)
        for texts in batches:
            yield pd.Series([[{"word": w, "weight": x} for w, x in telling.of(set(WORD.findall((text or "").lower())))] for text in texts])

    return found(text)


def telling_readings(restored: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Spans whose reading has words that speak for toxicity: span, telling."""

    @F.pandas_udf(_EVIDENCE)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        telling = Telling(weights)
        for lists in batches:
            yield pd.Series([[{"word": w, "weight": x} for w, x in telling.of(set(words))] for words in lists])

    return restored.select("span", found("words").alias("telling")).where(F.size("telling") > 0)


def _held_out(every: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, held_out: int = 5) -> DataFrame:
    """All columns of the documents in ``row``, and ``score``.

    Labels of documents whose crc32(doc_id as text) is divisible by ``held_out`` are not learnt from. Texts meet the
    telling words that they and their disguised spans hold by a join on their digest; only texts with any are in it.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = docs.select("doc_id", "text").where(~_held_out(held_out)).join(known, "doc_id")
    key = text_key(F.col("text")).alias("key")
    with small_batches(docs.sparkSession):
        spans = docs.select(key, F.explode(disguised_spans(F.col("text"))).alias("span"))
        spans = written_copy(spans.distinct(), "spans")
        counts = written_copy(trigram_counts(docs), "trigrams")
        restored = written_copy(restored_spans(spans.select("span").distinct(), counts), "restored")
        weights = fit(labelled, restored)
        plain = docs.select(key, F.explode(telling_words(F.col("text"), weights)).alias("t"))
        said = spans.join(telling_readings(restored, weights), "span").select("key", F.explode("telling").alias("t"))
        told = plain.unionByName(said).distinct().groupBy("key").agg(F.collect_list("t").alias("words"))
        told = written_copy(told, "telling")
    rows = docs.select(F.struct("*").alias("row"), key)
    words = F.coalesce("words", F.array().cast(_EVIDENCE))
    chances = F.array_sort(F.transform(words, lambda w: w["weight"]))  # in one order, whatever order they came in
    score = 1 - F.aggregate(chances, F.lit(1.0), lambda p, w: p * (1 - w))
    return rows.join(told, "key", "left").select("row", score.alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: int = 5) -> DataFrame:
    """Score and prediction for every document: doc_id, held_out, score, predicted."""
    found = scored(docs.select("doc_id", "text"), labels, held_out).select("row.doc_id", "score")
    return found.select("doc_id", _held_out(held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below one half, all columns as they are."""
    return scored(docs, labels).where(F.col("score") < 0.5).select("row.*")
