from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from turnstile.llm import conversation_repair as cr
from turnstile.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """The cheapest edits by searching all of them in order of cost, then letters: (cost, letters, repaired lines)."""
    faults, seen = [], set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and LEGAL.match(roles):
            return faults, cost, letters, lines
        # what may still follow depends on the last role only
        state = (i, roles[-1:])
        if state in done:
            continue
        done.add(state)

        def legal_start(found):
            return bool(re.match(r"(s|s?(ua)*u?)\Z", found))

        for role in ("user", "assistant"):
            if legal_start(roles + role[0]):
                heapq.heappush(heap, (cost + 2, letters + "I", i, roles + role[0], (*lines, f"{role}:")))
        if i < len(rows):
            (own, text), extra = rows[i], 1 if faults[i] == "truncated" else 0
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, roles, lines))
            if faults[i] not in ("blank", "duplicate"):
                if own and legal_start(roles + own[0]):
                    heapq.heappush(heap, (cost + extra, letters + "K", i + 1, roles + own[0], (*lines, f"{own}:{text}")))
                for role in ("user", "assistant"):
                    if legal_start(roles + role[0]):
                        heapq.heappush(heap, (cost + extra + 2, letters + "R", i + 1, roles + role[0], (*lines, f"{role}:{text}")))
    raise AssertionError("no way found")


def expected(table):
    """The report of plain rows (conv_id, turn, role, text), by its definition."""
    by_conv = {}
    for conv, turn, role, text in table:
        by_conv.setdefault(conv, [])
        as_text = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(as_text).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        by_conv[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {}
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
        numbers = {r[0] for r in rows if r[0] is not None}
        missing = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        faults, cost, letters, lines = brute([r[1:] for r in rows])
        initials = [r[1][:1] or "?" for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (missing, *counts, illegal, cost, letters, digest)
    return found


def compare(df, table):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == expected(table)
    assert len(rows) == len({r[0] for r in table})


ROLES = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "unknown"]
TEXTS = ["Yes.", "No!", "and", "", " \t", None, "what? ", "ends here.\n", "é…", "x" * 50_000 + "."]


def some_rows(seed, conversations):
    dice = random.Random(seed)
    for conv in [None, *range(conversations)]:
        for turn in range(dice.randint(1, 9)):
            yield conv, dice.choice([None, turn, turn, turn, turn + 3]), dice.choice(ROLES), dice.choice(TEXTS)


@pytest.mark.parametrize("seed", [1, 2])
def test_cheapest_least_edits_of_odd_conversations(spark, seed):
    from pyspark.sql import functions as F

    table = list(some_rows(seed, 120))
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(5)
    compare(cr.repair_report(df.withColumns({c: F.lit(1) for c in ("at", "block", "edits", "state", "line", "audit", "times")})), table)


def test_the_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(QUERIES["op13_checkpointed_repair"](spark, folder), table)


def test_programme_with_checkpoints_against_search():
    dice = random.Random(5)
    for n in [0, 1, 2, 3, 4, 5, 8, 9, 10, 40]:
        for _ in range(30):
            rows = [(dice.choice(["user", "assistant", "system", "x"]), f"{dice.randint(0, n)}{dice.choice(['.', '', '!'])}") for _ in range(n)]
            faults, cost, letters, _ = brute(rows)
            codes = "".join(cr.letter(role[0], fault) for (role, _), fault in zip(rows, faults, strict=True))
            total, turns = cr.cheapest_edits(codes)
            # The programme has nothing to say of no turns.
            assert (total, "".join(t for _, t in turns)) == (cost, letters), rows


def test_one_long_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_BITS", 3)
    dice = random.Random(8)
    table = [(7, turn, dice.choice(["user", "assistant"]), f"{dice.randint(0, 400)}.") for turn in range(600)]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(6)
    compare(cr.repair_report(df), table)


def test_string_ids_and_an_empty_table(spark):
    schema = "conv_id string, turn int, role string, text string"
    table = [("a", 1, "user", "Hi."), ("a", 2, "assistant", "Hello."), ("b", None, None, None)]
    compare(cr.repair_report(spark.createDataFrame(table, schema)), table)
    assert cr.repair_report(spark.createDataFrame([], schema)).collect() == []
