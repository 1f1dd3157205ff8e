"""The language model keeps every context, and every language has its share of training text."""

from __future__ import annotations

import math
import subprocess
import sys
from pathlib import Path

import numpy as np

from turnstile.llm import language


def slow_bits(run, grams):
    """Partial matching for one byte, method C with exclusion, by the definition."""
    excluded, spent = set(), 0.0
    for length in range(language.ORDER, -1, -1):
        context = run[language.ORDER - length : language.ORDER]
        seen = {}
        for gram, n in grams.items():
            if gram[language.ORDER - length : language.ORDER] == context and gram[-1] not in excluded:
                seen[gram[-1]] = seen.get(gram[-1], 0) + n
        if not seen:
            continue
        total = sum(seen.values()) + len(seen)
        if run[-1] in seen:
            return spent - math.log2(seen[run[-1]] / total)
        spent -= math.log2(len(seen) / total)
        excluded |= set(seen)
    return spent + math.log2(max(1, 256 - len(excluded)))


def test_code_lengths_by_the_definition():
    rng = np.random.default_rng(1)
    write = lambda n: bytes(rng.choice(list(b"abcde "), n, p=[0.4, 0.25, 0.15, 0.1, 0.05, 0.05]))
    grams = {name: language.gram_counts([write(80), write(30)]) for name in "xyz"}
    tree = language.build_tree(grams)
    text = write(60) + b"q" + write(10)
    padded = b" " * language.ORDER + text
    runs = [padded[i : i + language.ORDER + 1] for i in range(len(text))]
    expected = [sum(slow_bits(run, grams[name]) for run in runs) for name in "xyz"]
    assert np.allclose(language.code_lengths([text], tree)[0], expected)


def test_contexts_do_not_get_fewer_with_more_languages():
    rng = np.random.default_rng(2)
    one = language.gram_counts([rng.integers(97, 123, 5000).astype(np.uint8).tobytes()])
    many = {f"l{i}": language.gram_counts([rng.integers(97, 123, 5000).astype(np.uint8).tobytes()]) for i in range(70)}
    text = [b"abcdefgh" * 20]
    alone, among = language.build_tree({"a": one}), language.build_tree({"a": one, **many})
    assert language.code_lengths(text, alone)[0, 0] == language.code_lengths(text, among)[0, 0]


def test_few_long_documents_are_learnt_from(spark):
    said = {"en": "the cat and the dog went over the hill with ", "fr": "le chat et la souris sont dans la maison avec "}
    docs = [(i, said["en"] * 3, "en") for i in range(20)] + [(100 + i, said["fr"] * 5000, "fr") for i in range(4)]
    tree = language.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"), fit_bytes=8000)
    assert tree.languages == ["en", "fr"]
    learnt = [2 ** levels[0].start[0] - len(levels[0].grams) for levels in tree.levels]
    assert max(learnt) < 8000 + language.FIT_PIECE and learnt[1] >= 4096


def test_only_letters_make_a_language(spark):
    said = {"en": "the cat and the dog went over the hill with ", "fr": "le chat et la souris sont dans la maison avec "}
    docs = [(i, said[lang] * 3, lang) for i in range(20) for lang in said]
    asked = {100: "\u00bd \u00b2 \u2460", 101: "\u2167", 102: "12 _ !", 103: "\u4f60", 104: "\u00bd the"}
    docs += [(i, text, None) for i, text in asked.items()]
    got = {r.doc_id: r.lang_pred for r in language.languages(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert [got[i] == "und" for i in asked] == [True, True, True, False, False]


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver alone finds the package
from turnstile.session import build_session
from turnstile.llm import language
spark = build_session("elsewhere", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
docs = [(i, ("the cat and the dog " if i % 2 else "le chat et la souris ") * 5, "en" if i % 2 else "fr") for i in range(40)]
print("RIGHT", sum(r.lang_pred == docs[r.doc_id][2] for r in language.languages(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()))
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", ELSEWHERE, root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "RIGHT 40" in said.stdout, said.stderr[-3000:]
