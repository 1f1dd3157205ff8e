from __future__ import annotations

import random
from itertools import permutations

from turnstile.llm import filter_audit as fa

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """The rows of the audit by applying the filters in every order to plain (doc_id, text, source) rows."""
    marks = {}
    for doc, quality, toxic in labels:
        good, bad = marks.get(doc, (False, False))
        marks[doc] = (good or quality == 1, bad or toxic == 1)
    smallest = {}
    for doc, text, _ in docs:
        if doc is not None:
            smallest[text or ""] = min(doc, smallest.get(text or "", doc))
    parts = {}
    for doc, text, source in docs:
        text = text or ""
        words = [w for w in text.translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and smallest[text] < doc,
        }
        good, toxic = marks.get(doc, (False, False)) if doc is not None else (False, False)
        parts.setdefault(source or "", []).append((fails, good, toxic))
    rows = []
    for part, members in parts.items():
        told, ever = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                failing = [m for m in members if m[0][f]]
                alone = [m for m in failing if sum(m[0].values()) == 1]
                ever[f] += len(gone)
                told.append((f, (part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), len(alone), sum(m[1] for m in gone), sum(m[2] for m in gone))))
        rows += [(*row, ever[f]) for f, row in told]
    return sorted(rows)


def test_every_order_of_odd_documents(spark, odd, labels):
    docs = [tuple(r) for r in odd.select("doc_id", "text", "source").collect()]
    marks = [tuple(r) for r in labels.collect()]
    found = fa.filter_audit(odd.withColumnsRenamed({"n_chars": "mask"}).selectExpr("*", "1 AS part", "2 AS digest", "3 AS n", "4 AS good"), labels)
    assert found.columns == COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, marks)


def test_random_documents(spark):
    dice = random.Random(11)
    texts = ["A " * 250, "a b " * 150, "x # y", None, "", " ".join(str(i) for i in range(300)), " ".join(f"W{i}&" for i in range(300))]
    docs = [(dice.choice([None, *range(60)]), dice.choice(texts), dice.choice(["p", "q", None, ""])) for _ in range(400)]
    marks = [(i, dice.choice([0, 1, None]), dice.choice([0, 1, None])) for i in range(40)] + [(3, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    found = fa.filter_audit(df, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, marks)


def test_no_documents(spark, odd, labels):
    found = fa.filter_audit(odd.limit(0), labels)
    assert found.columns == COLUMNS and found.collect() == []


def test_swaps_run_through_all_orders():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for i in fa.adjacent_swaps(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.add(tuple(order))
        assert seen == set(permutations(range(n)))


def test_a_swapped_diagram_is_as_built_anew():
    dice = random.Random(2)
    weights = {m: (dice.randint(1, 3), 0) for m in range(32) if dice.random() < 0.6}
    diagram = fa.FailureDiagram(5, weights)
    for i in fa.adjacent_swaps(5):
        diagram.swap(i)
        nodes = [len(level) for level in diagram.levels]
        assert nodes[0] == 1 and all(n <= 2**i for i, n in enumerate(nodes))
        left = weights
        for f, kept, lost in diagram.all_pass_path():
            failing = {m: w for m, w in left.items() if m >> f & 1}
            left = {m: w for m, w in left.items() if not m >> f & 1}
            assert lost == tuple(sum(w[k] for w in failing.values()) for k in range(2))
            assert kept == tuple(sum(w[k] for w in left.values()) for k in range(2))
