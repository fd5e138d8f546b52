"""Personal spans against plain patterns, planted votes and planted disguises."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

pytest.importorskip("tastegrid.llm.queries")

from tastegrid.llm import personal  # noqa: E402
from tastegrid.session import local_session  # noqa: E402

SCHEMA = "doc_id long, text string, base string, spans int, candidates string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    spans = [(m.start(), k, m.end()) for k, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text)
             if holds(kind, m.group())]
    return sorted(spans)


def carded(draw):
    digits = "4" + "".join(draw.choices("0123456789", k=14))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def texts():
    draw = random.Random(3)
    pieces = ["a@b.c", "x@y", "@", ".", "_", "%", "1.2.3.4", "256.1.1.1", "001.2.3.4", "1.2.3.4.5.6.7.8.9", " ", "-", "+",
              "+1 (974) 555-3436", "+12345", "+1 ( ( (", "4111 1111 1111 1111", "4111-1111-1111-1112", "é", "🙂", "\n",
              "12", "1 2 3 4 5 6 7 8 9 0 1 2 3 4", "a.b@c-d.e.f", "@x.y", "...", "word", "0"]
    rows = ["", None, " \n", "🙂 é a@b.co 🙂 1.2.3.4 x", "9" * 30000 + " a" * 10000, "a" * 40000, "a.b@" * 5000 + "c.d",
            "1, 23, 456. " * 3000 + "me@x.org", "a@b.com_x@c.org a@b.com.@c.org"]
    return rows + ["".join(draw.choices(pieces, k=draw.randrange(1, 14))) for _ in range(600)]


def test_base_spans(spark):
    rows = [(i, t, "b", 1, "c") for i, t in enumerate(texts())] + [(None, "1.2.3.4", "", 1, ""), (1, "other 1.2.3.4", "", 1, "")]
    got = personal.personal_spans(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = {(i, t): base(t or "") for i, t, *_ in rows}
    assert len(got) == len(rows)
    shown = lambda spans: ",".join(f"{list(PLAIN)[k]}:{s}:{e}" for s, k, e in spans)
    by_id = {}
    for (i, _), spans in want.items():
        by_id.setdefault(i, set()).add((*(sum(k == n for _, k, _ in spans) for n in range(4)),
                                        hashlib.sha256(shown(spans).encode()).hexdigest()))
    for r in got:
        assert tuple(r)[1:6] in by_id[r.doc_id], r
    for r in got:  # base spans stay
        for _, spans in ((k, v) for k, v in want.items() if k[0] == r.doc_id and len(by_id[r.doc_id]) == 1):
            assert {*filter(None, shown(spans).split(","))} <= {*r.spans.split(",")}


def planted(draw, n=300):
    rows = []
    for i in range(n):
        card, phone = carded(draw), f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"
        ip = ".".join(str(draw.randrange(1, 224)) for _ in range(4))
        word = f"word{'x' * (i % 5)}"
        rows += [f"{word} {card} and more", f"see {phone} now", f"on {ip} there", f"by jane{i}@mail{i % 9}.example.com it",
                 f"a {draw.randrange(10**15, 10**16)} b"]
    return rows


DISGUISED = {
    "mail jane.doe [at] example [dot] com today": "jane.doe [at] example [dot] com",
    "mail joe (at) mail.example.org today": "joe (at) mail.example.org",
    "host 10[.]20[.]30[.]40 is up": "10[.]20[.]30[.]40",
    "pay 4111.1111.1111.1111 by card": "4111.1111.1111.1111",
    "both 4111111111111111 4012888888881881 cards": "4111111111111111",
    "call 974-555-3436 or": "974-555-3436",
}
CLEAN = ["look at this. And then at home", "version 1.2 of 2024-01-15", "ISBN 978-3-16-148410-0", "order 1234567812345678",
         "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "1234567812345678 8765432187654321", "300.400.500.600",
         "the 2nd at 10:30, pages 100-200", "meet at noon dot matrix"]


def test_disguises_are_added_and_clean_texts_left(spark):
    fit = planted(random.Random(1))
    rows = [*fit, *DISGUISED, *CLEAN]
    frame = spark.createDataFrame([(i, t, "", 0, "") for i, t in enumerate(rows)], SCHEMA)
    got = {r.doc_id: r.spans for r in personal.personal_spans(frame).collect()}
    for i, (text, found) in enumerate(DISGUISED.items(), len(fit)):
        at = text.index(found)
        assert f":{at}:{at + len(found)}" in got[i], (text, got[i])
    assert [got[i] for i in range(len(rows) - len(CLEAN), len(rows))] == [""] * len(CLEAN)
    for i, text in enumerate(fit):
        shown = ",".join(f"{list(PLAIN)[k]}:{s}:{e}" for s, k, e in base(text))
        assert got[i] == shown, (text, got[i])
    masked = {r.doc_id: r.text for r in personal.masked_texts(frame).collect()}
    assert masked[len(fit)] == "mail [email] today" and masked[len(fit) + 4] == "both [card] [card] cards"
    assert masked[len(rows) - 2] == CLEAN[-2]


def test_reliabilities_of_planted_votes():
    """Cells counted at a large and a small size, from known reliabilities, give them back and each other."""
    draw = random.Random(2)
    counts: dict[str, int] = {}
    truth = {}
    for _ in range(20000):
        true = draw.random() < .6
        said = {}
        for name, (yes, other) in personal.LABELERS.items():
            y, n = yes if true else other
            u = draw.random()
            said[name] = "yes" if u < y else "no" if u < y + n else "none"
        cell = "|".join(["kind=card", *(f"{k}={v}" for k, v in said.items()), "origin=wider", "parted=no", "digits=16"])
        counts[cell] = counts.get(cell, 0) + 1
        truth.setdefault(cell, []).append(true)
    cells = sorted(counts)
    likely, theta = personal.reliabilities(cells, [counts[c] for c in cells])
    for i, (yes, other) in enumerate(personal.LABELERS.values()):
        assert abs(theta[i][1][0] - yes[0]) < .05 and abs(theta[i][0][0] - other[0]) < .05
    sure = [np.mean(truth[c]) for c in cells]
    n = np.array([counts[c] for c in cells])
    assert np.sum(n * np.abs(likely - sure)) / n.sum() < .05
    again, _ = personal.reliabilities(cells, [100 * counts[c] for c in cells])
    assert np.allclose(likely, again)
    weights = personal.span_classifier(cells, n.tolist(), likely)
    scores = [1 / (1 + np.exp(-weights[""] - sum(weights[w] for w in c.split("|")))) for c in cells]
    assert np.sum(n * ((np.array(scores) > .5) == (likely > .5))) / n.sum() > .97


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert personal.personal_spans(none).count() == 0
    assert personal.masked_texts(none).count() == 0
    one = personal.personal_spans(spark.createDataFrame([(1, None, "", 0, "")], SCHEMA)).first()
    assert tuple(one) == (1, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
