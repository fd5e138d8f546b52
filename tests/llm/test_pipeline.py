"""The corpus pipeline on a small table, stage by stage, against plain loops."""

from __future__ import annotations

import re

import pytest

pytest.importorskip("tastegrid.llm.queries")

import corpus_pipeline  # noqa: E402
from tastegrid.session import local_session  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def numbered(a: int, b: int) -> str:
    return " ".join(f"Word{i}x" for i in range(a, b))


SHARED = numbered(7000, 7040)
ROWS = [
    (1, numbered(0, 100)), (2, numbered(0, 100)), (3, numbered(0, 98) + " other ending"),
    (4, numbered(200, 300) + " " + SHARED), (5, SHARED + " " + numbered(400, 500)),
    (6, numbered(600, 700)), (6, numbered(800, 900)), (6, numbered(800, 900)), (7, numbered(800, 899) + " end"),
    (8, None), (9, ""), (10, "too short"), (11, "again and again it goes " * 20), (None, numbered(950, 999)),
]


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is not None, *map(str, r)))


def kept_by_rules():
    kept = []
    for i, t in ROWS:
        w = WORD.findall(t or "")
        grams = [tuple(w[a:a + 8]) for a in range(len(w) - 7)]
        again = {k for a, g in enumerate(grams) if grams.count(g) > 1 for k in range(a, a + 8)}
        if len(w) >= 20 and 100 * len(again) <= 30 * len(w):
            kept.append((i, t))
    return kept


def without_near_copies(rows):
    named = sorted({r for r in rows if r[0] is not None})
    sets = [{tuple(w[a:a + 5]) for a in range(len(w) - 4)} for w in (WORD.findall(t.lower()) for _, t in named)]
    head = list(range(len(named)))
    for _ in named:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if 100 * len(x & y) >= 80 * len(x | y):
                    head[a] = head[b] = min(head[a], head[b])
    return [named[a] for a in sorted(set(head))] + [r for r in rows if r[0] is None]


def without_repeats(rows):
    raws = [t.encode() for _, t in rows]
    seen = {}
    for raw in raws:
        for a in range(len(raw) - 199):
            seen[raw[a:a + 200]] = seen.get(raw[a:a + 200], 0) + 1
    out = []
    for (i, _), raw in zip(rows, raws, strict=True):
        gone = {k for a in range(len(raw) - 199) if seen[raw[a:a + 200]] > 1 for k in range(a, a + 200)}
        out.append((i, bytes(x for k, x in enumerate(raw) if k not in gone).decode()))
    return out


def test_pipeline(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in ROWS], SCHEMA)
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(
        f"{folder}/labels.parquet")
    key = lambda r: (r[0] is not None, *map(str, r))

    passed = corpus_pipeline.quality_rules(spark, docs, folder)
    assert passed.columns == docs.columns
    assert rows_of(passed) == sorted(kept_by_rules(), key=key)  # no labels: the base check alone
    single = corpus_pipeline.near_copies(spark, passed, folder)
    expected = without_near_copies(kept_by_rules())
    assert single.columns == docs.columns and rows_of(single) == sorted(expected, key=key)
    assert [i for i, _ in rows_of(single)] == [None, 1, 4, 5, 6, 6]
    bare = corpus_pipeline.repeated_passages(spark, single, folder)
    assert bare.columns == docs.columns and rows_of(bare) == sorted(without_repeats(expected), key=key)
    assert all(r["n_chars"] == len(r["text"]) for r in bare.collect())

    from tokenizers import Tokenizer

    from tastegrid.llm.queries import tokenizer_file
    encode = Tokenizer.from_file(tokenizer_file(corpus_pipeline.TOKENIZER)).encode
    final = corpus_pipeline.packed_sequences(spark, bare, folder).collect()
    lengths = sorted(len(encode(t, add_special_tokens=False).ids) + 1 for _, t in without_repeats(expected))
    assert sorted(r["length"] for r in final) == lengths

    whole = corpus_pipeline.run(spark, folder).collect()  # without labels every score is 0.5
    good = [r for r in corpus_pipeline.quality_classifier(spark, passed, folder).collect()]
    assert len(whole) == (len(final) if good else 0)
