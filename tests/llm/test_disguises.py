"""Which spans are decoded, and that decoding them by bucket gives what the whole model gives."""

from __future__ import annotations

import itertools
import random

import pytest

from turnstile.llm import toxicity

CORPUS = " ".join(["solution fast letter button cotton station notion motion oil lot tin son ton"] * 40)
FORMS = [
    "s.o.l.u.t.i.o.n", '"s.o.l.u.t.i.o.n', "(s-o-l-u-t-i-o-n)", "s..o..l..u..t..i..o..n", "solu.tion", "solut-ion", "so_lu_tion",
    "soooolution", "s0lution", "$olut!on", "s o l u t i o n", "s\to\nl\tu t i\no n", "so1ution",
]


@pytest.fixture(scope="module")
def counts(spark):
    return toxicity.trigram_counts(spark.createDataFrame([(CORPUS,), (None,)], "text string"))


@pytest.mark.parametrize("form", FORMS)
def test_disguises_reach_the_decoder_and_are_restored(spark, form):
    spans = toxicity.spans_of(f"Well, {form} so")
    model = toxicity.character_model(spark.createDataFrame([(CORPUS,)], "text string"))
    read = {w for span in spans for w in toxicity.WORD.findall(toxicity.restore(toxicity.evened(span), model))}
    assert "solution" in read


def test_three_spaced_letters_are_a_span():
    assert "t i n" in toxicity.spans_of("a, t i n can")


def test_plain_words_do_not_reach_the_decoder():
    assert toxicity.spans_of('The "letter", his button; or not? 12 3.5 it.\nA B') == set()
    assert toxicity.spans_of(None) == toxicity.spans_of("") == set()


def test_spans_by_bucket_are_read_as_by_the_whole_model(spark, counts, monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKET_SPANS", 7)
    dice = random.Random(4)
    spans = sorted({"".join(dice.choice("solutin0!.-$q ") for _ in range(dice.randint(1, 9))) for _ in range(120)} | {"s.o.n" * 300, "日本.語"})
    model = toxicity.character_model(spark.createDataFrame([(CORPUS,)], "text string"))
    got = {r.span: r.words for r in toxicity.restored_spans(spark.createDataFrame([(s,) for s in spans], "span string"), counts).collect()}
    assert got == {s: toxicity.WORD.findall(toxicity.restore(s, model)) for s in spans}


def every_reading(span, model):
    """The cheapest reading by trying all of them."""
    best = None
    for choice in itertools.product(*toxicity._readings(span)):
        text, cost = "".join(t for t, _ in choice), sum(p for _, p in choice)
        state = "  "
        for letter in text + " ":
            cost += model.cost(state, letter)
            state = state[1] + letter
        if best is None or cost < best[0] - 1e-9:
            best = (cost, text)
    return best


def test_viterbi_finds_the_cheapest_of_all_readings(spark):
    model = toxicity.character_model(spark.createDataFrame([(CORPUS,)], "text string"))

    def cost_of(span, text):
        return min(
            sum(p for _, p in choice) + sum(model.cost((("  " + text)[i : i + 2]), (text + " ")[i]) for i in range(len(text) + 1))
            for choice in itertools.product(*toxicity._readings(span))
            if "".join(t for t, _ in choice) == text
        )

    dice = random.Random(9)
    for _ in range(150):
        span = "".join(dice.choice("slotin01!.-$6") for _ in range(dice.randint(1, 6)))
        read = toxicity.restore(span, model)
        assert cost_of(span, read) == pytest.approx(every_reading(span, model)[0]), span


def test_columns_of_any_name_come_back(spark):
    docs = spark.createDataFrame([(1, "fine words", 5, "x"), (None, None, 6, "y")], "doc_id long, text string, _toxicity int, score string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    docs = docs.withColumnsRenamed({"score": "key"}).selectExpr("*", "'p' AS plain", "'r' AS row", "'s' AS span")
    got = toxicity.without_toxic(docs, labels)
    assert got.columns == docs.columns and sorted(got.collect(), key=str) == sorted(docs.collect(), key=str)
