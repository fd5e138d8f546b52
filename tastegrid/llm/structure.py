"""Repair of a conversation's roles by generalised LR parsing with weighted edits.

The grammar of role initials is ``C -> (empty) | P | s P;  P -> P T | T;  T -> u a``.
A graph-structured stack is carried over the rows: its tops are the start, ``s``,
``u`` and ``P``; every top holds a link to the stack below it.  Each row may be
kept (0), given the role that the grammar asks for (1) or deleted (2), and turns
without text may be inserted (5 each).  A blank row, or one whose role and text
came earlier, must be deleted; a truncated row costs 5 more unless deleted.
Stacks with equal tops merge into the one with the least (cost, audit), where the
audit spells the edits: K, R, D, I.

The audits of two tops after the same rows consist of as many blocks ``I*[KRD]``,
none of which starts another, so their order is that of their parents and then
of their last blocks, and needs no comparison of whole audits.  Rows on which all
tops agree are handed on at once: a conversation of any length passes through in
order without being held.  Its rows are read by one task, as the digest of the
repaired turns must see them in order; what stays in memory are 16 bytes per
different row, to tell duplicates.

Rows are ordered by turn (nulls first), then role, then text.  A null role or text
is one space; rows with a null conv_id form one conversation.  Conversations
without rows after damage return zeros, an empty audit and the digest of nothing.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import count
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AGREE_EVERY = 32

START, SYSTEM, USER, PAIRS = range(4)
# what each top shifts; after an assistant's turn T -> u a and P -> P T | T are reduced at once
SHIFTS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": PAIRS}, PAIRS: {"u": USER}}
INSERTS = {START: "u", SYSTEM: "u", USER: "a", PAIRS: "u"}
ACCEPTED = (START, PAIRS)

Stack = tuple[int, Any]          # (top, the stack below)
Step = list                      # [step before, block of the audit, turns]


def pushed(stack: Stack, symbol: str) -> Stack:
    """The stack after a shift and the reductions that follow it."""
    top, below = stack
    if SHIFTS[top][symbol] != PAIRS:
        return SHIFTS[top][symbol], stack
    # T -> u a pops both turns; P -> P T pops the pairs before them as well
    return PAIRS, below[1] if below[0] == PAIRS else below


class Repair:
    """The graph-structured stack of one conversation; decided edits go to ``sink(block, turns)``."""

    def __init__(self, sink: Callable[[str, tuple], None]):
        self.sink, self.rows = sink, 0
        # top: (cost, rank among the audits, stack, last step)
        self.heads: dict[int, tuple[int, int, Stack, Step | None]] = {START: (0, 0, (START, None), None)}

    def opened(self) -> dict[int, tuple]:
        """Tops with turns inserted: (cost, rank, stack, step, inserted turns)."""
        best = {top: (*head, ()) for top, head in self.heads.items()}
        queue = list(best)
        while queue:
            top = queue.pop()
            cost, rank, stack, step, turns = best[top]
            symbol = INSERTS[top]
            to = pushed(stack, symbol)
            found = (cost + INSERT, rank, to, step, (*turns, (ROLES[symbol], "")))
            if to[0] not in best or found[:2] < best[to[0]][:2]:
                best[to[0]] = found
                queue.append(to[0])
        return best

    def feed(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """One more row."""
        found: dict[int, tuple] = {}

        def offer(cost: int, rank: int, block: str, stack: Stack, step: Step | None, turns: tuple) -> None:
            had = found.get(stack[0])
            if had is None or (cost, rank, block) < had[:3]:
                found[stack[0]] = (cost, rank, block, stack, step, turns)

        initial = role[:1]
        extra = TRUNCATED if truncated else 0
        for top, (cost, rank, stack, step, turns) in self.opened().items():
            inserted = "I" * len(turns)
            offer(cost + DELETE, rank, inserted + "D", stack, step, turns)
            if must_go:
                continue
            for symbol in SHIFTS[top]:
                if symbol == initial:
                    offer(cost + KEEP + extra, rank, inserted + "K", pushed(stack, symbol), step,
                          (*turns, (role, text)))
                if symbol in ROLES:
                    offer(cost + REROLE + extra, rank, inserted + "R", pushed(stack, symbol), step,
                          (*turns, (ROLES[symbol], text)))
        self.heads = {}
        useful = sorted((f for t, f in found.items() if not dominated(t, f[0], found)), key=lambda f: f[1:3])
        for rank, (cost, _, block, stack, step, turns) in enumerate(useful):
            self.heads[stack[0]] = (cost, rank, stack, [step, block, turns])
        self.rows += 1
        if self.rows % AGREE_EVERY == 0:
            self.agree()

    def agree(self) -> None:
        """Hand on the edits that all tops share."""
        steps = [h[3] for h in self.heads.values()]
        while steps[0] is not None and any(s is not steps[0] for s in steps):
            steps = [s[0] for s in steps]
        if steps[0] is not None:
            self.hand_on(steps[0])

    def hand_on(self, step: Step | None) -> None:
        decided = []
        while step is not None:
            decided.append(step)
            step = step[0]
        for s in reversed(decided):
            self.sink(s[1], s[2])
            s[0], s[1], s[2] = None, "", ()

    def finish(self) -> int:
        """The least cost, after all edits have been handed on."""
        ends = self.opened()
        cost, _, _, step, turns = min((ends[t] for t in ACCEPTED if t in ends), key=lambda e: e[:2])
        self.hand_on(step)
        if turns:
            self.sink("I" * len(turns), turns)
        return cost


def dominated(top: int, cost: int, found: dict[int, tuple]) -> bool:
    """Whether another top surely ends cheaper, whatever follows.

    Pairs accept all that ``s`` does, and all that the start does but for ``s``
    itself, whose deletion costs 2.  ``u`` becomes pairs by one insertion.
    """
    pairs = min([found[t][0] + by for t, by in ((PAIRS, 0), (USER, INSERT)) if t in found], default=None)
    if pairs is None or top in (USER, PAIRS):
        return False
    return cost > pairs + (DELETE if top == START else 0)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows after damage; dropped rows stay, marked ``gone`` and without text."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                case.alias("_case"))
    text = (F.when(F.col("_case") <= 1, "").when(F.col("_case") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("_case") == 4, "user").when(F.col("_case") == 0, "").otherwise(F.col("role"))
    times = F.when(F.col("_case") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("_case") == 0).alias("gone"),
                       F.explode(F.array_repeat(F.lit(0), times)).alias("_again")).drop("_again")


def undamaged(conversations: DataFrame) -> DataFrame:
    """The same columns without damage."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                F.lit(False).alias("gone"))


class Conversation:
    """Measures and repair of one conversation, fed row by row in order."""

    def __init__(self, conv_id: int | None, sink: Callable[[str, tuple], None]):
        self.conv_id, self.repair, self.seen = conv_id, Repair(sink), set()
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def feed(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
            self.turns += 1
        # the length of the role keeps role and text apart
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        bare = text.strip(WHITE)
        fault = "blank" if not bare else "duplicate" if key in self.seen else "truncated" if bare[-1] not in ".!?" else ""
        self.seen.add(key)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        self.repair.feed(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def counts(self) -> tuple[int, ...]:
        """The six measures; ends the repair."""
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.repair.finish()


class Digest:
    """Audit and digest of the repaired turns, taken as they are decided."""

    def __init__(self) -> None:
        self.blocks: list[str] = []
        self.sha, self.empty = hashlib.sha256(), True

    def __call__(self, block: str, turns: tuple) -> None:
        self.blocks.append(block)
        for role, text in turns:
            self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False


def _in_order(rows: DataFrame) -> DataFrame:
    """Conversations whole in their partitions and rows in order."""
    long = lambda c: F.col(c).cast("long").alias(c)
    return (rows.select(long("conv_id"), long("turn"), "role", "text", "gone").repartition("conv_id")
            .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"))


def _streamed(batches: Iterator[pa.RecordBatch], begin: Callable[[int | None], Conversation],
              end: Callable[[Conversation], None]) -> Iterator[None]:
    """Feed sorted rows to conversations, each opened by ``begin`` and given to ``end``; stops after every batch."""
    now = None
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(5))
        for conv_id, turn, role, text, gone in zip(*columns, strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    end(now)
                now = begin(conv_id)
            if not gone:
                now.feed(turn, role, text)
        yield
    if now is not None:
        end(now)
    yield


def _emptied(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """The rows held so far, which are held no longer."""
    out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)
    held.clear()
    return out


REPAIRS = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])
TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def conversation_repairs(rows: DataFrame) -> DataFrame:
    """conv_id, the six counts, audit and repaired_sha256 of every conversation of ``damaged`` or ``undamaged`` rows."""
    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def end(one: Conversation) -> None:
            counts, digest = one.counts(), one.repair.sink
            held.append((one.conv_id, *counts, "".join(digest.blocks), digest.sha.hexdigest()))

        for _ in _streamed(batches, lambda conv_id: Conversation(conv_id, Digest()), end):
            yield _emptied(held, REPAIRS)

    return _in_order(rows).mapInArrow(
        repaired, "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text of the repaired turns of ``damaged`` or ``undamaged`` rows."""
    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def begin(conv_id: int | None) -> Conversation:
            place = count()

            def sink(_block: str, decided: tuple) -> None:
                held.extend((conv_id, next(place), role, text) for role, text in decided)
            return Conversation(conv_id, sink)

        for _ in _streamed(batches, begin, Conversation.counts):
            yield _emptied(held, TURNS)

    return _in_order(rows).mapInArrow(turns, "conv_id long, place long, role string, text string")
