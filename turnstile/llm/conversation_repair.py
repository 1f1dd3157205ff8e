"""Conversations repaired by the cheapest edits, found by a dynamic programme with square-root checkpoints.

A well-formed conversation has the role initials ``(s?(ua)+)?``. Each turn may be kept, given the role that is due,
or deleted, and empty turns of the due role may be inserted; of all cheapest ways the one whose edit letters come
first in ASCII order is taken. Costs to the end are computed backwards, one small vector per turn, but only the
vectors at every sqrt(n)-th turn are stored; walking forward, each block's vectors are computed again from the
checkpoint behind it.

Rows are sorted over the whole table, so that a long conversation spans many tasks, and numbered once. Repeated
turns are found by grouping digests; one letter per turn, packed by blocks of at most 65,536 turns, is all that meets
for the programme, no more than the edit letters it returns. Texts are edited block by block. Only the SHA-256 of a whole
conversation, which is one chain by definition, reads a conversation's texts in one task, as a stream.

Defined results: a NULL role or text is one space, and so no role that could be kept, and no text; an empty role has no
initial and cannot be kept. Turns come by number, NULL first; of one number by role, then by the digest of the text.
Rows equal in all of these are told apart by the numbering only, and all but one are duplicates. A NULL
conversation is a conversation. One without rows gives zeros, no edits and the digest of the empty string. An empty
table gives no rows. Columns other than the four named are never read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.session import written_copy

SPACES = r"[\x20\x09-\x0D]"
BLOCK_BITS = 16  # turns a block holds, as a power of two

# What a conversation so far calls for: its start, after a system turn, after a user turn, after an assistant turn.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
INITIALS = "sua"
FAULTS = ("", "blank", "duplicate", "truncated")
# Where a kept turn of each initial leads from each state; None where it may not stand.
KEPT = {
    "s": (AFTER_SYSTEM, None, None, None),
    "u": (AFTER_USER, AFTER_USER, None, AFTER_USER),
    "a": (None, None, AFTER_ASSISTANT, None),
}
# The state after the turn that is due, inserted or by a new role, and that turn's role.
DUE = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
DUE_ROLE = ("user", "user", "assistant", "user")
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
AT_END = (0, 2 * INSERT, INSERT, 0)  # costs to a well-formed end from each state

Costs = tuple[int, int, int, int]


# --- rows --------------------------------------------------------------------------------------------------


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns with faults put in by the CRC-32 of ``conv_id:turn``: dropped, emptied, cut, repeated, or given to the user."""

    def or_space(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(or_space(conv_id), F.lit(":"), or_space(turn)).cast("binary")) % 20
    held = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), or_space(role).alias("role"), or_space(text).alias("text"), kind.alias("kind")
    )
    return held.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, at, role, text: all turns in order, ``at`` rising with it; written once, so that the numbers stay."""
    each = turns.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    # The last key parts equal rows, which could otherwise not be dealt to several tasks.
    in_order = each.orderBy("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")), F.rand(13))
    return written_copy(in_order.select("conv_id", F.monotonically_increasing_id().alias("at"), "role", "text"), "turns")


def coded(rows: DataFrame) -> DataFrame:
    """conv_id and codes: one letter per turn, for its role's initial and its first fault, as blocks in order."""
    last = F.regexp_extract("text", rf"(?s)([^\x20\x09-\x0D]){SPACES}*\z", 1)
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS))  # 0 for an empty role, 1 to 3, or 0 if another
    slim = rows.select(
        "conv_id",
        "at",
        "role",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.when(F.col("role") == "", 0).otherwise(initial).alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("truncated"),
    )
    first = slim.where(~F.col("blank")).groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("truncated"), 3).otherwise(0)
    letters = slim.join(first, "at", "left").select("conv_id", "at", F.char(65 + 4 * F.col("initial") + fault).alias("letter"))
    block = F.shiftright("at", BLOCK_BITS).alias("block")
    blocks = letters.groupBy("conv_id", block).agg(F.array_sort(F.collect_list(F.struct("at", "letter"))).alias("turns"))
    packed = blocks.select("conv_id", "block", F.array_join(F.col("turns.letter"), "").alias("letters"))
    return packed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "letters"))).alias("blocks"))


# --- the programme -----------------------------------------------------------------------------------------


def letter(initial: str, fault: str) -> str:
    """The code of a turn."""
    return chr(65 + 4 * (INITIALS.find(initial) + 1 if initial else 0) + FAULTS.index(fault))


def decoded(code: str) -> tuple[str, str]:
    number = ord(code) - 65
    return ("?" + INITIALS)[number // 4], FAULTS[number % 4]


@lru_cache(maxsize=1 << 16)
def before_turn(code: str, after: Costs) -> tuple[int, Costs, tuple[tuple[str, int], ...]]:
    """Costs to the end before a turn, from those behind it: the least, the rest over it, and each state's edit and next state.

    Vectors are given over their least entry, of which there are few, so nearly every turn finds its step known.
    """
    initial, fault = decoded(code)
    extra = TRUNCATED if fault == "truncated" else 0
    taken = []
    for state in range(4):
        ways = [(DELETE + after[state], "D", state)]
        if fault not in ("blank", "duplicate"):
            kept = KEPT[initial][state] if initial in KEPT else None
            if kept is not None:
                ways.append((extra + after[kept], "K", kept))
            ways.append((extra + REROLE + after[DUE[state]], "R", DUE[state]))
        taken.append(ways)
    costs = [min(cost for cost, _, _ in ways) for ways in taken]
    for _ in range(3):  # inserted turns lead to other states before the same turn; no cheapest way needs more than three
        costs = [min(cost, INSERT + costs[DUE[state]]) for state, cost in enumerate(costs)]
    edits = []
    for state, ways in enumerate(taken):
        ways = [*ways, (INSERT + costs[DUE[state]], "I", DUE[state])]
        edits.append(min((edit, to) for cost, edit, to in ways if cost == costs[state]))
    least = min(costs)
    return least, tuple(cost - least for cost in costs), tuple(edits)


def cheapest_edits(codes: str) -> tuple[int, list[tuple[int, str]]]:
    """The cost, and per turn the state before it and its edit letters, inserted turns before it first; the last one's end with turns inserted at the end."""
    n = len(codes)
    width = max(1, math.isqrt(n))
    stored, total, costs = {}, 0, AT_END
    for i in range(n - 1, -1, -1):
        if (i + 1) % width == 0 or i == n - 1:
            stored[i] = costs
        least, costs, _ = before_turn(codes[i], costs)
        total += least
    total += costs[START]
    found, state = [], START
    for begin in range(0, n, width):
        end = min(begin + width, n)
        costs, steps = stored[end - 1], []
        for i in range(end - 1, begin - 1, -1):
            _, costs, edits = before_turn(codes[i], costs)
            steps.append(edits)
        for edits in reversed(steps):
            came, told = state, ""
            while True:
                edit, state = edits[state]
                told += edit
                if edit != "I":
                    break
            found.append((came, told))
    if found:
        found[-1] = (found[-1][0], found[-1][1] + "I" * (AT_END[state] // INSERT))
    return total, found


def counted(codes: str) -> tuple[int, int, int, int]:
    """Blank, duplicate, truncated turns, and neighbours whose roles do not follow each other."""
    roles = "".join(decoded(code)[0] for code in codes)
    faults = [decoded(code)[1] for code in codes]
    illegal = sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(roles, roles[1:], strict=False)))
    return (*(faults.count(kind) for kind in FAULTS[1:]), illegal)


PIECES = "array<struct<block: long, state: int, edits: string>>"


def audited(codes: DataFrame) -> DataFrame:
    """Per conversation of ``coded``: its counts, cost, edit letters, and these again per block with the state it starts in."""
    key = codes.schema["conv_id"].dataType.simpleString()

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for blocks in batch["blocks"]:
                whole = "".join(b["letters"] for b in blocks)
                cost, turns = cheapest_edits(whole)
                pieces, begin = [], 0
                for b in blocks:
                    held = turns[begin : begin + len(b["letters"])]
                    begin += len(held)
                    # Letters of several edits stand for one turn; a comma ends each turn.
                    pieces.append({"block": b["block"], "state": held[0][0], "edits": ",".join(told for _, told in held)})
                rows.append((*counted(whole), cost, "".join(told for _, told in turns), pieces))
            told = pd.DataFrame(rows, columns=["blank", "duplicate", "truncated", "illegal", "cost", "audit", "pieces"])
            told.insert(0, "conv_id", batch["conv_id"].to_numpy())
            yield told

    schema = f"conv_id {key}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces {PIECES}"
    return codes.mapInPandas(walked, schema)


# --- the repaired turns ------------------------------------------------------------------------------------


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, at, line, role, text, in the order of ``at`` and ``line``.

    ``at`` is that of the turn edited, or of the one next to which a turn was inserted. Each block of turns meets its
    edits in one task, first in the stream, so a task holds the edits of one block and a batch of turns.
    """
    block = F.shiftright("at", BLOCK_BITS)
    pieces = audits.select("conv_id", F.inline("pieces")).select(
        "conv_id", "block", F.lit(-1).cast("long").alias("at"), "state", "edits", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")
    )
    turns = rows.select("conv_id", block.alias("block"), "at", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("edits"), "role", "text")
    stream = pieces.unionByName(turns).repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at")

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, state = iter(()), START
        for batch in batches:
            out = []
            columns = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "at", "state", "edits", "role", "text"))
            for conv, at, begin, letters, role, text in zip(*columns, strict=True):
                if letters is not None:
                    edits, state = iter(letters.split(",")), begin
                    continue
                for line, edit in enumerate(next(edits)):
                    if edit == "I":
                        out.append((conv, at, line, DUE_ROLE[state], ""))
                        state = DUE[state]
                    elif edit == "R":
                        out.append((conv, at, line, DUE_ROLE[state], text))
                        state = DUE[state]
                    elif edit == "K":
                        out.append((conv, at, line, role, text))
                        state = KEPT[role[0]][state]
            kinds = (batch.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.string(), pa.string())
            arrays = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "at", "line", "role", "text"])

    key = rows.schema["conv_id"].dataType.simpleString()
    return stream.mapInArrow(edited, f"conv_id {key}, at long, line int, role string, text string")


def transcript_digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text`` lines, joined by line feeds, as the lines stream by."""
    in_order = turns.repartition("conv_id").sortWithinPartitions("conv_id", "at", "line")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done = []
            columns = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "role", "text"))
            for conv, role, text in zip(*columns, strict=True):
                if digest is not None and conv == current:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = conv, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            yield _hashes(done, batch.schema.field("conv_id").type)
        if digest is not None:
            yield _hashes([(current, digest.hexdigest())], batch.schema.field("conv_id").type)

    key = turns.schema["conv_id"].dataType.simpleString()
    return in_order.mapInArrow(hashed, f"conv_id {key}, repaired_sha256 string")


def _hashes(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    arrays = [pa.array([r[0] for r in rows], key), pa.array([r[1] for r in rows], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "repaired_sha256"])


def gaps(turns: DataFrame) -> DataFrame:
    """Every conversation of ``damaged`` with how many numbers are missing between its first and last turn."""
    left = F.when(F.col("times") > 0, F.col("turn"))
    missing = F.max(left) - F.min(left) + 1 - F.count_distinct(left)
    return turns.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))


COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` after damage: its gaps and faults, the edits that mend it, and the digest of the result."""
    broken = damaged(turns)
    rows = numbered(broken)
    audits = written_copy(audited(coded(rows)), "audits")
    digests = transcript_digests(repaired(rows, audits))
    every = gaps(broken)
    told = audits.drop("pieces").withColumnRenamed("conv_id", "audited")
    ends = digests.withColumnRenamed("conv_id", "hashed")
    joined = every.join(told, F.col("conv_id").eqNullSafe(F.col("audited")), "left").join(ends, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
    return joined.select(
        "conv_id",
        "gaps",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
