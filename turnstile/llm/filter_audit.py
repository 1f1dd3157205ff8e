"""How filters interact: what each removes, in every order, from count-weighted decision diagrams.

Spark folds the documents to counts per part and failure mask (which filters a document fails): at most
2^filters rows a part, folded in each input task, so neither a hot part nor a hot text gathers anywhere. Each
part's counts become a decision diagram with one level per filter. Swapping two adjacent levels turns the diagram
of one order into that of the next; walking an order's all-pass path from the root gives its steps, as the weight
under the failing side of a level is what that filter removes there.

A document is a copy when a smaller doc_id, anywhere in the table, holds the identical text. Only the smallest
doc_id of a text is looked up, by doc_id and digest together, so copies never meet in one task.

Defined results: a NULL text is empty, a NULL part is the empty string, a NULL doc_id is neither smaller nor larger
than another and has no labels. Rows that repeat a doc_id count each; of one text they are no copies of each
other. Several labels of a doc_id count as one, and 1 wins. An empty table gives no rows. Other columns are never
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.texts import UPPER, whole, words
from turnstile.session import written_copy

# Conditions under which a text fails, by the letter of the filter.
TEXT_FILTERS: dict[str, Callable[[Column], Column]] = {
    "A": lambda text: F.size(words(text)) < 200,
    "B": lambda text: 100 * F.size(F.array_distinct(words(text))) < 50 * F.size(words(text)),
    "C": lambda text: 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))) > 2 * F.length(text),
    "D": lambda text: text.rlike(r"[#$%&*|]"),
}
COPY_FILTER = "E"
WEIGHTS = ("n", "good", "toxic")


def failures(
    docs: DataFrame, filters: dict[str, Callable[[Column], Column]], doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """Documents folded to doc_id, part, digest and mask with their number; bit i of the mask is filter i."""
    held = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        whole(F.col(text)).alias("text"),
    )
    bits = [F.when(fails(F.col("text")), 1 << i).otherwise(0) for i, fails in enumerate(filters.values())]
    mask = reduce(Column.__add__, bits, F.lit(0))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return held.select("doc_id", "part", digest.alias("digest"), mask.alias("mask")).groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))


def with_copies(folded: DataFrame, bit: int) -> DataFrame:
    """Set a bit of the mask where a smaller doc_id holds the same text."""
    first = folded.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "digest", F.lit(True).alias("first"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return folded.join(first, ["doc_id", "digest"], "left").withColumn("mask", F.col("mask") + F.when(copy, 1 << bit).otherwise(0))


def mask_counts(folded: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good ones and toxic ones per part and mask."""
    marked = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    )
    counted = [F.sum(F.col("n") * F.coalesce(F.col(w), F.lit(0))).alias(w) for w in WEIGHTS[1:]]
    return folded.join(marked, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), *counted)


Weight = tuple[int, ...]


@dataclass(eq=False)
class Node:
    """A filter's level on some path: what lies under passing and under failing it, and the weight of both."""

    passed: Node | None
    failed: Node | None
    total: Weight


class FailureDiagram:
    """A reduced decision diagram from failure masks to weights, one level per filter, whose levels can be swapped.

    Nodes with the same children are one node. ``levels[i]`` holds the nodes of the filter ``order[i]``, by their children.
    """

    def __init__(self, n_filters: int, weights: dict[int, Weight]):
        self.order = list(range(n_filters))
        self.levels: list[dict[tuple[int, int], Node]] = [{} for _ in self.order]
        self.leaves: dict[Weight, Node] = {}
        self.nothing = (0,) * len(next(iter(weights.values())))
        self.root = self._build(0, weights)

    def _build(self, level: int, weights: dict[int, Weight]) -> Node:
        if level == len(self.order):
            weight = next(iter(weights.values()), self.nothing)
            return self.leaves.setdefault(weight, Node(None, None, weight))
        bit = 1 << self.order[level]
        passed = self._build(level + 1, {m: w for m, w in weights.items() if not m & bit})
        failed = self._build(level + 1, {m: w for m, w in weights.items() if m & bit})
        return self._node(self.levels[level], passed, failed)

    @staticmethod
    def _node(level: dict[tuple[int, int], Node], passed: Node, failed: Node) -> Node:
        key = (id(passed), id(failed))
        if key not in level:
            level[key] = Node(passed, failed, tuple(a + b for a, b in zip(passed.total, failed.total, strict=True)))
        return level[key]

    def swap(self, i: int) -> None:
        """Exchange levels i and i + 1; nodes above keep their children, as a node of level i keeps its function."""
        lower: dict[tuple[int, int], Node] = {}
        upper: dict[tuple[int, int], Node] = {}
        for node in self.levels[i].values():
            passed, failed = node.passed, node.failed
            node.passed = self._node(lower, passed.passed, failed.passed)
            node.failed = self._node(lower, passed.failed, failed.failed)
            upper[id(node.passed), id(node.failed)] = node
        self.levels[i], self.levels[i + 1] = upper, lower
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def all_pass_path(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Each filter in order with the weights that pass it and that fail it, of what passed all before."""
        node = self.root
        for filter_no in self.order:
            yield filter_no, node.passed.total, node.failed.total
            node = node.passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places i whose swaps with i + 1, one after another, run through all orders of n things."""
    if n < 2:
        return
    inner = list(adjacent_swaps(n - 1))
    places, down = range(n - 1), True
    for turn in range(len(inner) + 1):
        yield from reversed(places) if down else places
        if turn < len(inner):
            # The travelling thing rests at the front or at the back of the others.
            yield inner[turn] + (1 if down else 0)
        down = not down


def orders(letters: str, weights: dict[int, Weight]) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order."""
    diagram = FailureDiagram(len(letters), weights)
    failing = [sum(w[0] for m, w in weights.items() if m >> f & 1) for f in range(len(letters))]
    alone = [weights.get(1 << f, (0,))[0] for f in range(len(letters))]
    found, removed_ever = [], [0] * len(letters)
    swaps = adjacent_swaps(len(letters))
    while True:
        name = "".join(letters[f] for f in diagram.order)
        for step, (f, kept, lost) in enumerate(diagram.all_pass_path(), 1):
            removed_ever[f] += lost[0]
            found.append((f, (name, step, kept[0], lost[0], failing[f] - lost[0], alone[f], lost[1], lost[2])))
        place = next(swaps, None)
        if place is None:
            return [(*row, removed_ever[f]) for f, row in found]
        diagram.swap(place)


AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def audit_orders(counts: DataFrame, letters: str) -> DataFrame:
    """The steps of every order of the filters, per part, from ``mask_counts``."""
    columns = [name.split()[0] for name in AUDIT.split(", ")]
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("masks"))  # 2^filters at most

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, masks in zip(batch["part"], batch["masks"], strict=True):
                weights = {m["mask"]: tuple(int(m[w]) for w in WEIGHTS) for m in masks}
                yield pd.DataFrame([(part, *row) for row in orders(letters, weights)], columns=columns)

    return per_part.mapInPandas(walked, AUDIT)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Filters A to E over the documents of each source: one row per part, order and step."""
    folded = written_copy(failures(docs, TEXT_FILTERS), "failures")
    marked = with_copies(folded, len(TEXT_FILTERS))
    return audit_orders(mask_counts(marked, labels), "".join(TEXT_FILTERS) + COPY_FILTER)
