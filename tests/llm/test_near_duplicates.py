"""The near-duplicate stage against brute force over all pairs of fingerprints."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from turnstile.llm import simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def staying(docs):
    """The smallest doc_id of each component of fingerprints at most three bits apart."""
    prints = [fingerprint(text) for _, text in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(docs, group):
        least[g] = min(doc_id, least.get(g, doc_id))
    return sorted(least.values())


def planted(rng):
    words = np.array([f"w{i}" for i in range(5000)])
    docs = []
    for i in range(25):
        text = rng.choice(words, int(rng.integers(3, 600)))
        for j in range(6):  # exact copies, light edits, appended words and other texts
            copy = list(text) + list(rng.choice(words, j // 2))
            copy[int(rng.integers(0, len(copy)))] = copy[0] if j < 2 else "new"
            docs.append((10 * i + j, " ".join(copy)))
        docs.append((10 * i + 6, " ".join(text).upper().replace(" ", "\n ")))
    docs += [(1000, ""), (1001, " \t "), (1002, None), (1003, "one"), (1004, "One")]
    return [docs[i] for i in rng.permutation(len(docs))]


def test_stage_against_brute_force(spark):
    docs = planted(np.random.default_rng(3))
    got = simhash.without_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    expected = staying(docs)
    assert 25 <= len(expected) < len(docs) - 30
    assert sorted(r.doc_id for r in got.collect()) == expected


def test_one_row_of_repeated_rows_stays(spark):
    data = [(1, "a b c d")] * 3 + [(1, "other words here")] + [(None, None)] * 2 + [(None, "no id at all")] * 2
    got = simhash.without_near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    told = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    assert told == [(0, ""), (0, "no id at all"), (1, "a b c d"), (1, "other words here")]


def test_clashing_columns_come_back(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    names = ("_number", "_NUMBER_", "number", "f0", "place", "root", "_row", "words", "i", "h", "band", "key", "node", "_md5", "_text_md5")
    docs = docs.withColumns({c: F.lit(c) for c in names})
    got = simhash.without_near_duplicates(docs)
    assert got.columns == docs.columns
    assert [r.asDict() for r in got.collect()] == [{"doc_id": 1, "text": "a b c d", **{c: c for c in names}}]
