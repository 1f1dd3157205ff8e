"""Language of whole texts by prediction by partial matching over bytes.

Each language has a context tree: how often each byte followed each context of up
to ``ORDER`` bytes in its training texts. A byte's code length under a language is
exact: from the longest context of the language that fits, with the chance of
escape (method C) to shorter ones, bytes already refused excluded, down to equal
chances for all bytes. The language with the shortest code is predicted.

The statistics are frozen and kept sparsely: for each language the contexts and the
bytes seen after them, sorted by code. Every context of the training texts is kept,
however many languages there are. A follower of a context follows its shorter
contexts too, so what is excluded after an escape depends on the context escaped
from alone, and costs add up along the shortening contexts. A batch of texts is read
as its distinct runs of bytes; every text is read whole, in pieces that overlap by a
context.

Training uses at most ``FIT_BYTES`` of text a language, and ``FIT_TOTAL`` of all
languages, and one piece each (documented bounds), in pieces of ``FIT_PIECE`` letters
drawn by hash from all its texts, and at least one; counting it is a grouped sum. The
driver gets the counted grams as Arrow columns: at most one of 12 bytes and a name for
each byte learnt from, one language at a time.

Defined results: a NULL text, or one without a letter (Unicode category L, so digits,
fractions and letter-like numbers are none), is ``und`` with score 0, as
is every text if no training text has a language. Equal texts get equal results,
ties go to the smaller name. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.texts import whole
from turnstile.session import scratch_path

ORDER = 4
FIT_BYTES = 2_000_000
FIT_TOTAL = 64_000_000
FIT_PIECE = 4096  # letters
PIECE = 1 << 20  # bytes of one text that are read at once
BATCH_BYTES = 1 << 21


@dataclass(frozen=True)
class Contexts:
    """A language's contexts of one length and the grams of a context and a byte, by code.

    Costs in bits. A gram costs its context's ``start``, or the ``entry`` of the longer
    context escaped from, less its ``seen``. ``leave`` is the escape of a context no
    longer one precedes, ``entry`` and ``on`` are what its shorter context gives and
    costs to escape once this one's followers are excluded.
    """

    grams: np.ndarray
    seen: np.ndarray
    codes: np.ndarray
    start: np.ndarray
    leave: np.ndarray
    entry: np.ndarray
    on: np.ndarray


@dataclass(frozen=True)
class ContextTree:
    """For each language its contexts by length, and the bits of a byte that no text had."""

    languages: list[str]
    levels: list[list[Contexts]]
    unseen: list[float]

    @property
    def bits(self) -> np.ndarray:
        """All code lengths after all full contexts, a row for each context and byte: for small trees."""
        codes = np.unique(np.concatenate([levels[ORDER].codes for levels in self.levels]))
        grams = (codes[:, None] << np.uint64(8) | np.arange(256, dtype=np.uint64)).ravel()
        return np.stack([_bits(grams, *model) for model in zip(self.levels, self.unseen)], axis=1)


def _runs(padded: bytes) -> np.ndarray:
    """The code of the ORDER + 1 bytes that end at each byte after the first ORDER."""
    data = np.frombuffer(padded, np.uint8)
    size = len(data) - ORDER
    codes = np.zeros(size, np.uint64)
    for i in range(ORDER + 1):
        codes = (codes << np.uint64(8)) | data[i : i + size]
    return codes


def gram_counts(texts: list[bytes], before: list[bytes] | None = None) -> dict[bytes, int]:
    """How often each run of ORDER + 1 bytes occurs; each text follows what is before it, after ORDER spaces."""
    found: dict[bytes, int] = defaultdict(int)
    for text, context in zip(texts, before or [b""] * len(texts)):
        for code, n in zip(*np.unique(_runs(context.rjust(ORDER, b" ")[-ORDER:] + text), return_counts=True)):
            found[int(code).to_bytes(ORDER + 1, "big")] += int(n)
    return found


def build_tree(grams: dict[str, dict[bytes, int]]) -> ContextTree:
    """The tree from each language's gram counts."""
    return _tree(
        {
            name: (np.array([int.from_bytes(gram, "big") for gram in counts], np.uint64), np.array(list(counts.values()), float))
            for name, counts in grams.items()
        }
    )


def _tree(grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> ContextTree:
    languages = sorted(grams)
    built = [_levels(*grams[name]) for name in languages]
    return ContextTree(languages, [levels for levels, _ in built], [unseen for _, unseen in built])


def _levels(full: np.ndarray, many: np.ndarray) -> tuple[list[Contexts], float]:
    """Contexts by length from the codes of grams of ORDER + 1 bytes and their counts."""
    levels: list[Contexts] = []
    shorter, shorter_n = np.zeros(0, np.uint64), np.zeros(0)
    totals, kinds, parent = np.zeros(0), np.zeros(0), np.zeros(0, np.uint64)
    for length in range(ORDER + 1):
        grams, place = np.unique(full & np.uint64((1 << 8 * (length + 1)) - 1), return_inverse=True)
        n = np.bincount(place, many, len(grams))
        codes, of = np.unique(grams >> np.uint64(8), return_inverse=True)
        total, kind = np.bincount(of, n, len(codes)), np.bincount(of, minlength=len(codes)).astype(float)
        start = np.log2(total + kind)
        entry, on = np.zeros(len(codes)), np.zeros(len(codes))
        if length:
            below = np.searchsorted(shorter, grams & np.uint64((1 << 8 * length) - 1))
            up = np.searchsorted(parent, codes & np.uint64((1 << 8 * (length - 1)) - 1))
            new = kinds[up] - kind
            left = totals[up] - np.bincount(of, shorter_n[below], len(codes)) + new
            some = new > 0  # a shorter context without another follower is passed over
            entry[some] = np.log2(left[some])
            on[some] = entry[some] - np.log2(new[some])
        levels.append(Contexts(grams, np.log2(n), codes, start, start - np.log2(kind), entry, on))
        shorter, shorter_n, totals, kinds, parent = grams, n, total, kind, codes
    return levels, math.log2(max(1, 256 - len(levels[0].grams)))


def _find(codes: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the asked codes are in sorted codes, and whether they are."""
    at = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
    return at, codes[at] == asked


def _bits(runs: np.ndarray, levels: list[Contexts], unseen: float) -> np.ndarray:
    """Bits of the last byte of each run of ORDER + 1 bytes, sorted or not, under one language."""
    cost, spent = np.zeros(len(runs)), np.zeros(len(runs))
    entry = np.full(len(runs), -1.0)  # of the longer context escaped from; -1 without one
    on = np.zeros(len(runs))
    rows = np.arange(len(runs))
    for length in range(ORDER, -1, -1):
        level = levels[length]
        grams = runs[rows] & np.uint64((1 << 8 * (length + 1)) - 1)
        context, known = _find(level.codes, grams >> np.uint64(8))
        gram, seen = _find(level.grams, grams)
        first = entry[rows] < 0
        cost[rows[seen]] = (spent[rows] + np.where(first, level.start[context], entry[rows]) - level.seen[gram])[seen]
        rest = ~seen
        rows, context, known, first = rows[rest], context[rest], known[rest], first[rest]
        spent[rows] += np.where(known, np.where(first, level.leave[context], on[rows]), 0)
        went = rows[known]
        entry[went], on[went] = level.entry[context[known]], level.on[context[known]]
    cost[rows] = spent[rows] + unseen
    return cost


def code_lengths(texts: list[bytes], tree: ContextTree) -> np.ndarray:
    """Bits of each text under each language."""
    total = np.zeros((len(texts), len(tree.languages)))
    pieces, owners, size = [], [], 0

    def read() -> None:
        if not pieces:
            return
        codes = _runs(b" " * ORDER + b"".join(pieces))
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes) - sizes
        counted = np.ones(len(codes), bool)
        for i in range(ORDER):  # the bytes before a piece are context only
            counted[starts + i] = False
        runs, place = np.unique(codes, return_inverse=True)
        for column, model in enumerate(zip(tree.levels, tree.unseen)):
            costs = np.where(counted, _bits(runs, *model)[place], 0)
            np.add.at(total[:, column], owners, np.add.reduceat(costs, starts))
        pieces.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for start in range(0, len(text), PIECE):
            before = text[max(0, start - ORDER) : start].rjust(ORDER, b" ")
            pieces.append(before + text[start : start + PIECE])
            owners.append(i)
            size += len(pieces[-1])
            if size >= BATCH_BYTES:
                read()
                size = 0
    read()
    return total


def train(docs: DataFrame, fit_bytes: int = FIT_BYTES) -> ContextTree | None:
    """The tree of a sample of (doc_id, text, lang); None without any."""
    spark = docs.sparkSession
    known = docs.where("lang is not null and text <> ''").select(
        "lang", "text", F.xxhash64(F.lit("fit"), "doc_id", "text").alias("drawn"), F.length("text").alias("letters")
    )
    sizes = known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("drawn").alias("_least"))
    # one row a language, written so that the planner knows how small it is and leaves the texts where they are
    path = scratch_path(spark, "shares")
    sizes.select(F.col("lang").alias("_lang"), "bytes", "_least").write.parquet(path)
    shares = spark.read.parquet(path)
    fit_bytes = min(fit_bytes, FIT_TOTAL // max(1, shares.count()))
    # twice what is asked, of which the first by hash are taken
    upto = F.ceil(F.least(2 * fit_bytes / F.col("bytes"), F.lit(1.0)) * (1 << 30)).alias("upto")
    shares = shares.select("_lang", upto, "_least")
    numbers = F.sequence(F.lit(0), F.floor((F.col("letters") - 1) / FIT_PIECE).cast("int"))
    place = lambda b: F.xxhash64("drawn", b)
    taken = F.filter(
        numbers,
        lambda b: (F.pmod(place(b), F.lit(1 << 30)) < F.col("upto")) | ((b == 0) & (F.col("drawn") == F.col("_least"))),
    )
    piece = lambda b: F.struct(
        place(b).alias("place"),
        F.substring("text", b * FIT_PIECE + 1, F.lit(FIT_PIECE)).alias("text"),
        F.when(b > 0, F.substring("text", b * FIT_PIECE + 1 - ORDER, F.lit(ORDER))).otherwise("").alias("before"),
    )
    pieces = known.join(shares, F.col("lang") == F.col("_lang")).select("lang", F.explode(F.transform(taken, piece)).alias("piece"))
    order = Window.partitionBy("lang").orderBy("piece.place", "piece.text").rowsBetween(Window.unboundedPreceding, -1)
    sofar = F.coalesce(F.sum(F.octet_length("piece.text")).over(order), F.lit(0))
    learnt = pieces.withColumn("sofar", sofar).where(F.col("sofar") < fit_bytes).select("lang", "piece.text", "piece.before")

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, rows in frame.groupby("lang"):
                counts = gram_counts([t.encode() for t in rows["text"]], [t.encode() for t in rows["before"]])
                codes = [int.from_bytes(gram, "big") for gram in counts]
                yield pd.DataFrame({"lang": lang, "gram": codes, "n": list(counts.values())})

    path = scratch_path(spark, "grams")
    learnt.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    ).write.parquet(path)
    counted_grams = spark.read.parquet(path)
    grams = {}
    for lang in [row["lang"] for row in counted_grams.select("lang").distinct().collect()]:
        table = counted_grams.where(F.col("lang") == lang).select("gram", "n").toArrow()
        grams[lang] = table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy().astype(float)
    return _tree(grams) if grams else None


def predicted(docs: DataFrame, tree: ContextTree | None, keep: list[Column]) -> DataFrame:
    """``keep``, lang_pred and score, for every document."""
    named = docs.select(*keep, whole(F.col("text")).alias("_text"))
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    if tree is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # plain arrays, which executors read without this package; at most ORDER + 1 grams a byte learnt from
    arrays = [[[getattr(level, f.name) for f in fields(Contexts)] for level in levels] for levels in tree.levels]
    shared = docs.sparkSession.sparkContext.broadcast((tree.languages, arrays, tree.unseen))

    def told(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, arrays, unseen = shared.value
        model = ContextTree(names, [[Contexts(*level) for level in levels] for levels in arrays], unseen)
        for frame in frames:
            texts = list(frame.pop("_text"))
            bits = code_lengths([t.encode() for t in texts], model)
            best = bits.argmin(axis=1)
            less = bits - bits.min(axis=1, keepdims=True)
            score = 1 / np.exp2(-np.minimum(less, 1000)).sum(axis=1)
            letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)  # category L
            names = np.array(model.languages, object)[best]
            yield frame.assign(lang_pred=np.where(letters, names, "und"), score=np.where(letters, score, 0.0))

    return named.mapInPandas(told, schema)


def languages(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Documents whose crc32(doc_id as text) leaves the remainder ``fold`` are not learnt from.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))
    tree = train(docs.where(~out).select("doc_id", "text", "lang"))
    return predicted(docs, tree, [F.col("doc_id"), out.alias("held_out")])
