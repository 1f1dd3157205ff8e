"""Operators on documents against brute force, and on rows that are odd in every way."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from turnstile.llm import decontaminate, exact_dedup, language, mixing, quality, sharding, simhash, toxicity
from turnstile.llm.bk_trees import distances, spanning_links
from turnstile.llm.components import components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def listed(df):
    return [tuple(r) for r in df.collect()]


# --- exact duplicates ---------------------------------------------------------


def test_exact_duplicates_of_odd_rows(odd):
    rows = odd.collect()
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(odd).collect()}
    groups: dict[str, list] = {}
    for r in rows:
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).hexdigest()
        groups.setdefault(digest, []).append(r)
    for digest, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        for r in members:
            told = got[r.doc_id]
            assert (told.text_sha256, told.keep_id, told.group_size) == (digest, best.doc_id, len(members))
            assert told.kept == (r.doc_id == best.doc_id)


def test_an_index_keeps_what_it_knows_and_takes_what_is_better(spark):
    index = exact_dedup.DigestIndex.fresh(spark, buckets=4)
    make = lambda data: exact_dedup.digests(spark.createDataFrame(data, "doc_id long, text string"))
    index.append(make([(5, "a b"), (6, "c")]))
    index.append(make([(1, "ab"), (7, "c"), (8, "d")]))  # shorter, later, new
    index.append(make([(9, "a  b")]))  # longer
    assert sorted((r.best.keep_id, -r.best.short) for r in index.best().collect()) == [(6, 1), (8, 1), (9, 4)]
    assert spark.table(index.table).count() == 4
    index.append(make([]))
    assert spark.table(index.table).count() == 4
    index.drop()


def test_the_index_is_not_shuffled_for_the_join(spark):
    index = exact_dedup.DigestIndex.fresh(spark, buckets=4)
    rows = exact_dedup.digests(spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")))
    index.append(rows)
    plan = index.spark.table(index.table).groupBy("text_sha256").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    index.drop()


# --- shards -------------------------------------------------------------------


def test_longest_first():
    assert sharding.longest_first([(7, "a"), (5, "b"), (4, "c"), (3, "d"), (3, "e")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert sharding.longest_first([], 2) == {}


def test_shards_are_level_gapless_and_keep_groups(spark):
    data = [(i, f"text {i % 700} " + "x" * (i % 700 % 97)) for i in range(2000)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = sharding.sharded(docs).collect()
    assert len(got) == 2000
    loads, slots, shard_of = {}, {}, {}
    text = dict(data)
    for r in got:
        assert r.size == len(text[r.doc_id]) + 1 and r.law == "bytes" and r.grown_shard is None
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert shard_of.setdefault(text[r.doc_id], r.shard) == r.shard
    assert sorted(loads) == list(range(16))
    assert max(loads.values()) - min(loads.values()) <= 400
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_those_of_longest_first(spark):
    rng = np.random.default_rng(11)
    sizes = [int(n) for n in rng.pareto(1.2, 300) * 50 + 1]
    docs = [(i, f"{i} " + "x" * n) for i, n in enumerate(sizes)] + [(1000 + i, f"{i} " + "x" * sizes[i]) for i in range(0, 300, 3)]
    totals = {}
    for _, text in docs:
        totals[text] = totals.get(text, 0) + len(text) + 1
    loads = [0] * 16
    for size in sorted(totals.values(), reverse=True):
        loads[loads.index(min(loads))] += size
    got = {}
    for r in sharding.sharded(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got[r.shard] = got.get(r.shard, 0) + r.size
    assert sorted(got.values()) == sorted(loads)


def test_equal_groups_come_to_a_shard_each(spark):
    for trial in range(3):
        docs = [(i, f"{trial} {i:02} " + "x" * 100_000) for i in range(16)] + [(100 + i, f"{trial} {i}") for i in range(200)]
        got = sharding.sharded(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        assert sorted(r.shard for r in got if r.doc_id < 16) == list(range(16))


def test_many_small_groups_level_the_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ALONE", 4)  # most groups travel in bundles
    monkeypatch.setattr(sharding, "SLOTS", 64)
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit("y"), (F.col("id") % 50).cast("int"))).alias("text"))
    loads = [r[1] for r in sharding.sharded(docs).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(loads) == 16 and max(loads) - min(loads) < 0.02 * sum(loads) / 16


def test_columns_beside_the_shards_come_back(spark):
    names = ("block", "first", "group", "class", "total", "row", "n", "SLOT_")
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "doc_id long, text string").withColumns({c: F.lit(c) for c in names})
    got = sharding.shard_documents(docs, keep=docs.columns)
    assert got.columns == [*docs.columns, "size", "text_crc32", "shard", "slot"]
    assert all(r[c] == c for r in got.collect() for c in names) and got.count() == 3


def test_shards_of_odd_and_empty_tables(odd):
    got = sharding.sharded(odd).collect()
    assert len(got) == odd.count()
    assert sorted(r.size for r in got if r.doc_id in (3, 4)) == [1, 1]
    assert len({r.shard for r in got if r.doc_id == 6}) == 1
    assert sharding.sharded(odd.limit(0)).collect() == []
    assert {"text", "slot", "shard"} <= set(sharding.shard_documents(odd, keep=odd.columns).columns)


# --- mixing -------------------------------------------------------------------


def test_targets_are_filled_level(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), (None, 10), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.water_levels(sizes).collect()}
    # weights 3, 1, 2, 3: "a" and NULL are cut at twice their size, "b" gets the rest
    assert got == {"a": 200.0, "b": 1445.0, "c": 0.0, None: 20.0}


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"),
    )
    got = mixing.mixed(docs).collect()
    taken, target = {}, {}
    for r in got:
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    assert sorted(listed(mixing.mixed(docs))) == sorted(tuple(r) for r in got)
    assert mixing.mixture(docs).count() == sum(r.taken // r.size for r in got if r.size) + sum(
        1 for r in mixing.planned(docs).collect() if not r.row.text for _ in range(r._taken)
    )


def test_mix_of_documents_without_ids_and_with_clashing_columns(spark):
    data = [(None, f"n{i} " + "w " * 19, "a") for i in range(600)] + [(i, f"d{i} " + "w " * 19, "b") for i in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    for r in mixing.mixed(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 20
    names = ("_source", "_copy", "_taken", "_threshold", "row", "col", "hash", "prefix")
    mix = mixing.mixture(docs.withColumns({c: F.lit(c) for c in names}))
    assert mix.columns == ["doc_id", "text", "source", *names]
    assert mix.where("not (" + " and ".join(f"`{c}` = '{c}'" for c in names) + ")").count() == 0
    assert mix.count() == sum(r.taken for r in mixing.mixed(docs).collect()) / 20


def test_mix_of_odd_and_empty_tables(odd):
    got = mixing.mixed(odd).collect()
    assert len(got) == odd.count()
    assert {r.size for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert mixing.mixture(odd).columns == odd.columns
    assert mixing.mixed(odd.limit(0)).collect() == []


# --- benchmark passages ---------------------------------------------------------


def brute_contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda text: word.findall((text or "").translate(UPPER))
    windows = {}
    for item, text in items:
        words = cut(text)
        n = min(10, len(words))
        for s in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[s : s + n]), set()).add(str(item))
    for doc_id, text in docs:
        words = cut(text)
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                if (w := tuple(words[s : s + n])) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[w]
        yield doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_passages_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["the", "of", "Dog", "cat", "é", "9", "x1"]
    say = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, say(int(rng.integers(1, 40)))) for i in range(30)] + [(30, None), (31, ""), (10, "the of. dog"), (2, "lone")]
    docs = []
    for i in range(120):
        parts = [say(int(rng.integers(0, 60)))]
        if i % 2:
            text = items[int(rng.integers(0, 30))][1].split()
            parts += [", ".join(text[int(rng.integers(0, 3)) :]), say(5)]
        docs.append((i, " ".join(parts).upper() if i % 5 == 0 else " ".join(parts)))
    docs += [(200, None), (201, ""), (1, docs[1][1])]
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert sorted(listed(got)) == sorted(brute_contamination(docs, items))


def test_passages_of_odd_and_empty_tables(spark, odd):
    items = spark.createDataFrame([(None, "the cat sat on the mat and looked at the moon"), (4, None)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(odd, items).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1].contaminated) == (11, 0, True)
    assert not got[3].contaminated and not got[8].contaminated
    assert decontaminate.contamination(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(odd.limit(0), items).collect() == []
    clean = decontaminate.without_passages(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 2


# --- SimHash --------------------------------------------------------------------


def connected(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize(("width", "radius"), [(1, 3), (1, 12), (4, 40)])
def test_trees_find_all_links(width, radius):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, size=(20, width), dtype=np.uint64)
    prints = base[rng.integers(0, 20, 300)].copy()
    for i in range(300):
        for _ in range(rng.integers(0, 7 * width)):
            prints[i, rng.integers(0, width)] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    prints = np.unique(prints, axis=0)
    n = len(prints)
    shard = np.sort(rng.integers(0, 5, n))
    for in_tree in (np.ones(n, bool), rng.random(n) < 0.5):
        u, v, far = spanning_links(prints, shard, in_tree, radius)
        assert (distances(prints[u], prints[v]) == far).all() and (far <= radius).all() and (shard[u] == shard[v]).all()
        brute = [
            (a, b) for a in range(n) for b in range(a)
            if shard[a] == shard[b] and (in_tree[a] or in_tree[b]) and distances(prints[a : a + 1], prints[b : b + 1])[0] <= radius
        ]
        assert connected(n, zip(u, v)) == connected(n, brute)
        assert len(u) < 2 * n


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (7, 7), (200, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100, 200: 100}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def brute_simhash(docs):
    prints = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = np.array([xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles], dtype=np.uint64)
        prints.append(sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes)))
    near = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = connected(len(docs), near)
    least = {}
    for (doc_id, _), root in zip(docs, roots):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted((d if d is not None else -1, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(docs, prints, roots))


def test_simhash_against_brute_force(spark, odd, monkeypatch):
    monkeypatch.setattr(simhash, "TREE_ROWS", 8)  # shards of several trees
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for i in range(20):
        text = list(rng.choice(words, 60))
        for j in range(8):
            copy = list(text)
            for _ in range(j // 2):
                copy[int(rng.integers(0, 60))] = "new"
            docs.append((100 + 8 * i + j, " ".join(copy)))
    got = simhash.linked_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    told = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in got.collect())
    assert told == brute_simhash(docs)


@pytest.mark.parametrize("chosen", [1, 2, 3, 4])
def test_links_by_any_choice_of_blocks(spark, chosen):
    rng = np.random.default_rng(chosen)
    prints = [int(p) for p in rng.integers(0, 2**63, 30, dtype=np.uint64)]
    prints += [p ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for p in prints for _ in range(4)]
    prints = sorted(set(prints))
    nodes = spark.createDataFrame([(simhash.signed(p),) for p in prints], "f0 long")
    root = {r.f0 % 2**64: r.root for r in simhash.components_of(nodes, 3, chosen).collect()}
    n = len(prints)
    brute = connected(n, [(a, b) for a in range(n) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    same = {}
    assert all(same.setdefault(root[p], label) == label for p, label in zip(prints, brute)) and len(same) == len(set(brute))


def test_more_fingerprints_choose_more_blocks():
    assert [simhash.chosen_blocks(10**e, 3) for e in (0, 6, 8, 9, 11, 12, 13, 15)] == [1, 1, 1, 2, 3, 3, 4, 4]


def test_simhash_of_an_empty_table(odd):
    assert simhash.linked_documents(odd.limit(0)).collect() == []


def test_one_of_each_group_of_near_duplicates_stays(spark, odd):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(2000)]
    docs, alone = [], []
    for i in range(12):
        text = list(rng.choice(words, 200))
        docs.append((100 * i, " ".join(text)))
        for j in range(1, 6):  # nearer than three bits or not, as brute force tells
            copy = list(text)
            copy[int(rng.integers(0, 200))] = "new"
            docs.append((100 * i + j, " ".join(copy)))
        half = " ".join(text[:100] + list(rng.choice(words, 100)))  # half alike: stays
        docs.append((100 * i + 50, half))
        alone.append(100 * i + 50)
    kept = sorted(r.doc_id for r in simhash.without_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert kept == sorted({least for _, _, least in brute_simhash(docs)})
    assert set(alone) < set(kept) and len(kept) < len(docs)
    rest = simhash.without_near_duplicates(odd)
    assert rest.columns == odd.columns
    # texts 1 and 2 differ in white space only; 3, 4 and 5 have no words; of the repeated row 6 one stays
    assert sorted((r.doc_id or -1) for r in rest.collect()) == [-1, 1, 3, 6, 7, 8, 9]
    assert simhash.without_near_duplicates(odd.limit(0)).collect() == []


# --- toxicity, language, quality ----------------------------------------------------


def test_disguised_words_are_restored(spark):
    said = "you are an idiot and a moron with a stupid pathetic plan for the trash clown " * 3
    model = toxicity.character_model(spark.createDataFrame([(said,), (None,), ("",)], "text string"))
    read = lambda span: toxicity.restore(span, model)
    assert [read(x) for x in ("id1ot", "i d i o t", "m.o.r.o.n", "stuuuupid", "p@thetic", "tra$h", "cl0wn")] == [
        "idiot", "idiot", "moron", "stupid", "pathetic", "trash", "clown",
    ]
    assert read("plan") == "plan" and read("") == ""
    assert len(read("a " * 3000 + "a")) >= 1


def test_toxic_texts_are_found_and_clean_ones_left(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("aeioulnrst"), 6)) for _ in range(400)]
    docs, labels = [], []
    for i in range(600):
        text = list(rng.choice(words, 40))
        toxic = i % 6 == 0
        if toxic:
            text[int(rng.integers(0, 40))] = ["grumble", "gr*mble", "gruuumble", "g r u m b l e"][i // 6 % 4] if i % 5 == 0 else "grumble"
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, known).collect()}
    held = [r for r in got.values() if r.held_out]
    assert len(got) == 600 and 60 < len(held) < 180
    assert sum(r.predicted != (r.doc_id % 6 == 0) for r in held) <= 0.02 * len(held)
    assert toxicity.without_toxic(docs, known).count() == sum(r.predicted == 0 for r in got.values())


def test_toxicity_of_odd_and_empty_tables(odd, labels):
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(odd.limit(0), labels).collect() == []
    assert toxicity.without_toxic(odd, labels).columns == odd.columns


def test_code_lengths_are_those_of_partial_matching():
    tree = language.build_tree({"x": language.gram_counts([b"abab"]), "y": language.gram_counts([b"aaaa"])})
    bits = 2.0 ** -tree.bits.reshape(-1, 256, 2).astype(float)
    assert np.allclose(bits.sum(axis=1), 1, atol=1e-3)  # chances of all bytes after any context
    one = language.code_lengths([b"ab" * 5, b"", b"aaaa"], tree)
    assert one[0, 0] < one[0, 1] and one[2, 1] < one[2, 0] and (one[1] == 0).all()
    long = language.code_lengths([b"abba" * 700_000], tree)  # in pieces
    assert np.isclose(long[0], language.code_lengths([b"abba" * 1000], tree)[0] * 700, rtol=1e-3).all()


def test_languages_are_told_apart(spark):
    said = {"en": "the cat and the dog went over the hill with ", "fr": "le chat et la souris sont dans la maison avec ", "de": "der hund und die katze sind in dem haus mit "}
    docs = [(i, said[lang] * (1 + i % 3) + str(i), lang) for i in range(60) for lang in [("en", "fr", "de")[i % 3]]]
    docs += [(100, None, "en"), (101, "12 34", "en"), (102, "", None), (103, said["fr"], None)]
    got = {r.doc_id: r for r in language.languages(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == ("en", "fr", "de")[i % 3] for i in range(60))
    assert [got[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "und", "fr"]
    assert all(0 <= r.score <= 1 for r in got.values()) and 0 < sum(r.held_out for r in got.values()) < 60


def test_languages_of_odd_and_empty_tables(odd):
    assert language.languages(odd).count() == odd.count()
    assert {r.lang_pred for r in language.languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.languages(odd.limit(0)).collect() == []


def test_quality_shrinks_sparse_paths(spark, odd, labels):
    host, path = F.col("source"), F.concat_ws("/", "source", "lang")
    data = [(i, "good plain words here", "en", "big" if i % 2 else "bad") for i in range(400)] + [(1000, "good plain words here", "fr", "big")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality(docs, known, host, path).collect()}
    assert len(got) == 401 and got[1].path_share > 0.9 and got[0].path_share < 0.1
    assert 0.5 < got[1000].path_share <= got[1].path_share  # no label of its own: its host's
    odd_rows = quality.quality(odd, labels, host, path).collect()
    assert len(odd_rows) == odd.count() and all(0 < r.score < 1 for r in odd_rows)
    assert {r.path_share for r in quality.quality(odd, labels.limit(0), host, path).collect()} == {0.5}
    assert quality.quality(odd.limit(0), labels, host, path).collect() == []
