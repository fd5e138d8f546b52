"""Conversation repair against all edit sequences of small conversations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

pytest.importorskip("tastegrid.llm.queries")

from tastegrid.llm import structure  # noqa: E402
from tastegrid.session import local_session  # noqa: E402

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, gone int, cost string"


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(structure.WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_force(rows):
    """Least (cost, audit) over all edit sequences with at most 4 insertions, and its turns."""
    found = faults(rows)
    best = None

    def walk(i, cost, audit, turns, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        initials = "".join(r[:1] if r[:1] in tuple("sua") else "x" for r, _ in turns)
        if not re.match(r"(s?(ua)*u?)?\Z", initials):
            return
        if i == len(rows) and GRAMMAR.match(initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, turns)
        if i < len(rows):
            role, text = rows[i]
            walk(i + 1, cost + 2, audit + "D", turns, inserted)
            if found[i] not in ("blank", "duplicate"):
                extra = 5 if found[i] == "truncated" else 0
                walk(i + 1, cost + extra, audit + "K", [*turns, (role, text)], inserted)
                for to in ("user", "assistant"):
                    walk(i + 1, cost + 1 + extra, audit + "R", [*turns, (to, text)], inserted)
        if inserted < 4:
            for to in ("user", "assistant"):
                walk(i, cost + 5, audit + "I", [*turns, (to, "")], inserted + 1)

    walk(0, 0, "", [], 0)
    return best


def repaired(rows):
    digest = structure.Digest()
    one = structure.Conversation(1, digest)
    for turn, (role, text) in enumerate(rows):
        one.feed(turn, role, text)
    return one.counts()[-1], "".join(digest.blocks), digest.sha.hexdigest()


def sha(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def test_all_edits():
    draw = random.Random(5)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", " ", "", "uncle"]
    texts = ["a.", "b!", "c?", "cut", " ", "", "x. \n"]
    for _ in range(400):
        rows = [(draw.choice(roles), draw.choice(texts) if draw.random() < .4 else f"{draw.random()}.")
                for _ in range(draw.randrange(6))]
        cost, audit, turns = brute_force(rows)
        assert repaired(rows) == (cost, audit, sha(turns)), rows


def test_insertion_pays_when_edits_are_dear(monkeypatch):
    monkeypatch.setattr(structure, "DELETE", 20)
    monkeypatch.setattr(structure, "REROLE", 20)
    digest = structure.Digest()
    repair = structure.Repair(digest)
    for role, text in [("system", "a."), ("user", "b."), ("user", "c."), ("assistant", "d."), ("user", "e.")]:
        repair.feed(role, text, False, False)
    assert (repair.finish(), "".join(digest.blocks)) == (10, "KKIKKKI")


def test_long_conversation_is_handed_on():
    """Decided turns leave early, and the result is that of the whole."""
    held, most = [], 0
    one = structure.Conversation(1, lambda block, turns: held.append(block))
    for i in range(5000):
        one.feed(i, ("user", "assistant")[i % 2] if i % 7 else "user", f"{i}.")
        most = max(most, i + 1 - len(held))
    one.counts()
    assert most <= 4 * structure.AGREE_EVERY
    assert len("".join(held).replace("I", "")) == 5000


ROWS = [
    *[(1, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(40)],
    *[(2, t, ("system", "user", "assistant")[t % 3], f"text! {t % 5}") for t in range(12)],
    (3, None, "user", "first."), (3, 0, "assistant", None), (3, 5, None, "what?"), (3, 9, "assistant", "b."),
    (3, 9, "assistant", "a."), (3, 9, "assistant", "a."), (None, 1, "user", "no id."), (None, None, None, None),
    (4, None, "user", " "), (5, 3, "", ""), *[(6 + i, 0, "user", "x.") for i in range(40)],
]


def expected_repairs():
    conversations = defaultdict(list)
    for conv, turn, role, text in ROWS:
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        rows = conversations[conv]
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        rows += [(turn, role, text)] * (2 if case == 3 else 1)
    out = {}
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in rows if t is not None}
        found = faults([r[1:] for r in rows])
        initials = [r[1][:1] for r in rows]
        cost, audit, digest = repaired([r[1:] for r in rows])
        if len(rows) <= 5:
            c, a, kept = brute_force([r[1:] for r in rows])
            assert (cost, audit, digest) == (c, a, sha(kept))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"),
                     found.count("duplicate"), found.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, digest)
    return out


def test_tables(spark):
    rows = spark.createDataFrame([(*r, 1, "c") for r in ROWS], SCHEMA).repartition(3)
    got = structure.conversation_repairs(structure.damaged(rows)).collect()
    want = expected_repairs()
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert any(w[-2] == "" for w in want.values())
    turns = structure.repaired_turns(structure.damaged(rows)).orderBy("conv_id", "place").collect()
    texts = defaultdict(list)
    for r in turns:
        texts[r.conv_id].append((r.role, r.text))
    assert {c: sha(texts.get(c, [])) for c in want} == {c: w[-1] for c, w in want.items()}


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert structure.conversation_repairs(structure.damaged(none)).count() == 0
    assert structure.repaired_turns(structure.undamaged(none)).count() == 0
