"""Operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tastegrid.llm.queries")

from tastegrid.llm import (arrays, byte_bpe, components, fingerprints, jaccard, memo, packing, quality,  # noqa: E402
                           rules, sharding, substrings, suffixes, toxicity)
from tastegrid.llm.queries import tokenizer_file  # noqa: E402
from tastegrid.session import local_session  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, kept string"


def numbered(a: int, b: int) -> str:
    return " ".join(f"Word{i}x" for i in range(a, b))


PASSAGE = numbered(5000, 5060)
ROWS = [
    (0, None, "en"), (1, "", None), (2, " \t\n", "fr"), (3, "one", "en"), (4, "Éé three words", "de"),
    (5, numbered(0, 200), "en"), (6, numbered(0, 200), "en"), (7, numbered(0, 195) + " changed", "es"),
    (8, numbered(300, 340) + " " + PASSAGE + " " + numbered(340, 380), "en"),
    (9, PASSAGE + " " + numbered(400, 450), "en"), (10, "a " * 900, "xx"), (11, "é" * 700, "fr"),
    (12, numbered(0, 200).upper(), "en"), (13, "it's <|endoftext|> 12  x\n\ny　z 🙂", "en"),
    (14, numbered(1000, 4000), "en"), (15, "b\n" * 40 + PASSAGE, "en"), (15, "b\n" * 40 + PASSAGE, "en"),
]


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, "s", 1, 2, "k") for i, t, g in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts() -> list[tuple[int, str]]:
    return [(i, t or "") for i, t, _ in ROWS]


def test_jaccard(docs, none):
    sets = {}
    for i, t in texts():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[a:a + 4]) for a in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}
    head = {i: i for i in sets}
    for _ in sets:
        for i, x in sets.items():
            for j, y in sets.items():
                if x and y and 100 * len(x & y) >= 85 * len(x | y):
                    head[i] = head[j] = min(head[i], head[j])
    for rows in (4096, 1):
        got = jaccard.jaccard_groups(docs, tile_rows=rows).collect()
        assert {r[0]: (r[1], r[2]) for r in got} == {i: (len(sets[i]), head[i]) for i in sets}
        assert len(got) == len(ROWS)
    assert jaccard.jaccard_groups(none).count() == 0


def test_jaccard_of_rows_that_share_an_id(spark):
    """Every text of an id takes part in links, whichever row comes first."""
    a, b = numbered(0, 100), numbered(500, 600)
    rows = [(6, a), (6, b), (7, b + " more"), (8, a + " else"), (9, numbered(900, 950)), (None, a), (9, "")]
    for some in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, "k") for i, t in some], SCHEMA)
        got = jaccard.jaccard_groups(docs).collect()
        assert sorted(((r[0] or 0, r[1], r[2] or 0) for r in got)) == [
            (0, 97, 0), (6, 97, 6), (6, 97, 6), (7, 98, 6), (8, 98, 6), (9, 0, 9), (9, 47, 9)]
        groups = defaultdict(set)
        for r in got:
            groups[r["group_id"]].add(r["doc_id"])
        assert groups.pop(None) == {None, 9} and sorted(map(sorted, groups.values())) == [[6, 7], [6, 8], [9]]


def test_wide_bitmaps(spark):
    """Long texts of unlike sizes: close ones link, and the bound rules no link out."""
    long_texts = [(1, numbered(0, 4100)), (2, numbered(0, 4000) + " " + numbered(9000, 9100)),
                  (3, numbered(0, 3000) + " " + numbered(20000, 21000)), (4, numbered(30000, 34200)),
                  (5, numbered(0, 3900)), (6, numbered(30000, 34050)), (7, numbered(30100, 34050) + " x")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, "k") for i, t in long_texts], SCHEMA)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_groups(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1, 6: 4, 7: 4}
    order = spark.sparkContext.broadcast(jaccard.frequencies(docs, 4).tobytes())
    sets = jaccard.signed_sets(docs, 4, 85, order)
    assert {r["doc_id"]: len(r["wide"]) for r in sets.collect()} == {1: 128, 2: 128, 3: 64, 4: 128, 5: 64, 6: 64, 7: 64}
    pairs = spark.createDataFrame([(1, 5), (2, 5), (1, 3), (1, 4), (3, 6), (4, 7), (1, 99)], "a long, b long")
    kept = {tuple(r) for r in jaccard.close_when_wide(
        pairs, sets.withColumn("set_a", sets["doc_id"]), 85).select("a", "b").collect()}
    assert kept >= {(1, 5), (2, 5), (4, 7), (1, 99)} and not kept & {(1, 4), (3, 6)}


def test_jaccard_of_many_edits(spark, monkeypatch):
    """Sets of all sizes with edits of their own, against all pairs."""
    rng = np.random.default_rng(5)
    rows = []
    for group, words in enumerate((5, 9, 30, 64, 70, 130, 400)):
        base = [f"g{group}w{i}" for i in range(words)]
        for _ in range(9):
            edit = list(base[:words - int(rng.integers(0, 1 + words // 8))])
            for at in rng.integers(0, len(edit), int(rng.integers(0, 3))):
                edit[at] = f"x{rng.integers(0, 3)}"
            rows.append((int(len(rows) * 37 % 101), " ".join(edit), "en", "s", 1, 2, "k"))
    sets = {r[0]: {tuple(w[a:a + 4]) for a in range(len(w) - 3)} for r in rows for w in [r[1].split()]}
    head = {i: i for i in sets}
    for _ in range(20):
        for i, x in sets.items():
            for j, y in sets.items():
                if 100 * len(x & y) >= 85 * len(x | y):
                    head[i] = head[j] = min(head[i], head[j])
    made, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: made.append(name) or written(df, name))
    got = jaccard.jaccard_groups(spark.createDataFrame(rows, SCHEMA), tile_rows=9).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == head
    # postings are dealt by tile at once, and not stored before their tiles are
    assert "tiles" in made and "postings" not in made


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 60), (60, 50), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(chain).collect()}
    assert got == dict.fromkeys(range(41), 0) | {50: 50, 60: 50}


def test_packing(docs, none):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in texts()}
    got = packing.pack_documents(docs, path).collect()
    places = defaultdict(list)
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        raw = b"".join(x.to_bytes(4, "little") for x in part)
        assert (len(part), zlib.crc32(raw), r["start"]) == (r["length"], r["ids_crc32"], 2048 * r["piece"])
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in got) == sum(len(ids[i]) for i, _ in texts())
    assert packing.pack_documents(none, path).count() == 0


def test_packing_words_are_looked_up_once():
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = ["Abc abc ABC. abc, abc", None, "", "h\u0331 H\u0331 J\u030c j\u030c Ab", "<|ENDOFTEXT|> <|endoftext|>Ab <|x",
             "don't DON'T. a..b x_y. \u00c9t\u00e9! \u0130 \u212a \u00c0 12.5% $$$ '' a'. \u03a3\u03a3 \u4e2d\u6587. x\u00a0y",
             "\n a\tb\x0bc\x0c d\x1ce\r"]
    encode = packing.WordIds(path)
    looked_up = []
    part = encode.part
    encode.part = lambda p: looked_up.append(p) or part(p)
    got = list(encode(pa.array(["none", *texts])[1:]))
    assert got == [array("I", plain.encode(t or "", add_special_tokens=False).ids).tobytes() for t in texts]
    assert looked_up.count("abc") == 1 and "ABC" not in encode.words and "Abc" not in encode.words
    assert list(encode(pa.array([], pa.string()))) == []


def test_packing_plan():
    plan = packing.Plan({2048: 3, 1500: 10, 548: 7, 600: 5, 100: 400, 1: 9}, 2048)
    used: dict[int, list] = defaultdict(list)
    for n, first, last, per, sequence, at in plan.places:
        for rank in range(last - first):
            used[sequence + rank // per].append((at + rank % per * n, n))
    assert Counter(n for parts in used.values() for _, n in parts) == {2048: 3, 1500: 10, 548: 7, 600: 5,
                                                                       100: 400, 1: 9}
    for parts in used.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048


def test_byte_bpe(docs, none):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in byte_bpe.encoded_digests(docs, path).collect()}
    for i, t in texts():
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    back = byte_bpe.decoded_texts(byte_bpe.encoded_ids(docs, path), path).collect()
    assert {r["doc_id"]: r["text"] for r in back} == dict(texts())
    assert byte_bpe.encoded_digests(none, path).count() == 0


def test_sharding(docs, none):
    got = sharding.shard_documents(docs, shards=4).collect()
    assert len(got) == len(ROWS)
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in got:
        by_text[r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.longest_first([("a", 5), ("b", 4), ("c", 3), ("d", 3)], [0, 0]) == {"a": 0, "b": 1, "c": 1, "d": 0}
    assert sharding.shard_documents(none).count() == 0


def test_substrings(docs, none):
    seen, expected = {}, {}
    for i, t in texts():
        w = WORD.findall(t)
        gone = set()
        for a in range(len(w) - 19):
            if seen.setdefault(tuple(w[a:a + 20]), (i, a)) != (i, a):
                gone.update(range(a, a + 20))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substrings.removed_windows(docs, cells=1 << 16).drop("kept").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected and len(got) == len(ROWS)
    assert substrings.removed_windows(none, cells=1 << 16).count() == 0


def test_suffixes(docs, none):
    count = Counter(t.encode()[a:a + 200] for _, t in texts() for a in range(len(t.encode()) - 199))
    expected = {}
    for i, t in texts():
        raw = t.encode()
        gone = {k for a in range(len(raw) - 199) if count[raw[a:a + 200]] > 1 for k in range(a, a + 200)}
        kept = bytes(x for k, x in enumerate(raw) if k not in gone)
        spans = sum(k - 1 not in gone for k in gone)
        expected[i] = (len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest())
    for rows in (2048, 2):
        got = suffixes.removed_bytes(docs, cells=1 << 16, bucket_rows=rows).drop("kept").collect()
        assert {r[0]: tuple(r)[1:] for r in got} == expected and len(got) == len(ROWS)
    assert suffixes.removed_bytes(none, cells=1 << 16).count() == 0


def test_intervals():
    assert sorted(suffixes.intervals([3, 1, 2])) == [(1, 0, 3), (2, 2, 3), (3, 0, 1)]


def test_fingerprints(docs, none):
    got = fingerprints.fingerprinted(docs).collect()
    order = sorted(texts(), key=lambda x: -x[0])
    edited = defaultdict(set)
    for k, (i, t) in enumerate(order):
        cut = len(t) // 3
        edited[i].add(hashlib.sha256((t[:len(t) - cut] + order[(k + 1) % len(order)][1][:cut]).encode()).hexdigest())
    prints = defaultdict(set)
    for r in got:
        assert r["edited_sha256"] in edited[r["doc_id"]]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        prints[dict(texts())[r["doc_id"]]].add(r["fingerprint"])
    assert len(got) == len(ROWS) and all(len(p) == 1 for p in prints.values())
    assert fingerprints.fingerprinted(none).count() == 0


def test_next_of_distant_repeated_and_null_ids(spark):
    ids = [*range(300), -2**63, 2**63 - 1, 2**62, *[77] * 200, *[None] * 150]
    rows = [(i, f"text {k} of {i}") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (4096, 1, 3):
        got = fingerprints.with_next(docs, ("doc_id", "text"), lambda df: df, parts).collect()
        follows = {(r["doc_id"], r["text"]): (r["next_doc_id"], r["next_text"]) for r in got}
        assert len(follows) == len(rows) and set(follows) == set(follows.values()) == set(rows)
        at, seen = max(rows, key=lambda r: -2**64 if r[0] is None else r[0]), []
        while at not in seen:
            seen.append(at)
            at = follows[at]
        assert len(seen) == len(rows)  # one ring
        order = [-2**64 if i is None else i for i, _ in seen]
        assert order == sorted(order, reverse=True)
    sizes = [r["count"] for r in fingerprints.ranged(docs).groupBy("_range").count().collect()]
    assert max(sizes) < 100  # neither the repeated id, nor null, nor the ids between the distant ones


def plain_anchors(tokens, k, s):
    """Closed syncmers step by step: {hash: first place}, the smallest ``KEEP`` hashes."""
    import xxhash

    def chained(parts):
        seed = 42
        for x in parts:
            seed = xxhash.xxh64_intdigest(x if isinstance(x, bytes) else x.to_bytes(8, "little"), seed)
        return seed

    def signed(h):
        return h - (1 << 64) if h >> 63 else h

    inner = [chained(t.encode() for t in tokens[i:i + s]) for i in range(len(tokens) - s + 1)]
    places = {}
    if tokens and not inner:
        places[chained(t.encode() for t in tokens) >> 32] = 0
    elif len(inner) <= k - s:
        for i, h in reversed(list(enumerate(inner))):
            places[h >> 32] = i
    else:
        for i in reversed(range(len(inner) - (k - s))):
            window = inner[i:i + k - s + 1]
            if min(map(signed, window)) in (signed(window[0]), signed(window[-1])):
                places[chained(window) >> 32] = i
    return dict(sorted(places.items())[:fingerprints.KEEP])


def plain_likeness(x, y):
    if not x and not y:
        return 1.0
    smallest = sorted(set(x) | set(y))[:fingerprints.KEEP]
    share = sum(h in x and h in y and abs(x[h] - y[h]) <= fingerprints.SHIFT for h in smallest) / len(smallest)
    return 2 * share / (1 + share)


def test_fingerprints_step_by_step(spark):
    """Anchors and likenesses of every text equal those of a plain loop."""
    rows = [(i, t) for i, t in dict(texts()).items()] + [(50, "x" * 600), (51, "tiny"), (52, numbered(0, 90) + " z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprinted(docs).collect()}

    def both(t):
        return plain_anchors(WORD.findall(t), 3, 1), plain_anchors(list(t), 8, 3) if len(t) <= 512 else None

    def near(x, y):
        at = int(x[1] is not None and y[1] is not None)
        return plain_likeness(x[at], y[at])

    def shown(pair):
        return "|".join(" ".join(f"{h:X}:{at}" for h, at in (p or {}).items()) for p in pair)

    ring = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(ring):
        after = ring[(k + 1) % len(ring)][1]
        cut = len(t) // 3
        own, edited = both(t), both(t[:len(t) - cut] + after[:cut])
        assert got[i]["fingerprint"] == shown(own), i
        assert got[i]["edited_fingerprint"] == shown(edited), i
        assert got[i]["near_edited"] == pytest.approx(near(own, edited)), i
        assert got[i]["near_next"] == pytest.approx(near(own, both(after))), i


def test_rules(spark, docs, none):
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in ROWS], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in rules.rule_verdicts(docs, labels).collect()}
    for i, t in texts():
        w = WORD.findall(t)
        count = Counter(tuple(w[a:a + 8]) for a in range(len(w) - 7))
        again = {k for a in range(len(w) - 7) if count[tuple(w[a:a + 8])] > 1 for k in range(a, a + 8)}
        lines = [s for s in t.split("\n") if WORD.search(s)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(again))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert r["base_failed"] == (len(w) < 20 or 100 * len(again) > 30 * len(w))
        assert r["kept"] == (not r["base_failed"])  # too few labels for any rule
    kept = rules.kept_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not got[i]["base_failed"] for i, _, _ in ROWS)
    assert rules.rule_verdicts(none, labels).count() == 0


def test_binomial_tail(spark):
    from math import comb


    df = spark.createDataFrame([(0, 50), (3, 50), (50, 50), (2, 4000)], "k long, n long")
    got = df.select("k", "n", rules.binomial_tail(F.col("k"), F.col("n"), 0.05).alias("p")).collect()
    for k, n, p in got:
        assert p == pytest.approx(sum(comb(n, i) * 0.05**i * 0.95**(n - i) for i in range(k + 1)), rel=1e-6)


def test_quality(spark, none):
    rows = [(i, (numbered(i, i + 30) if i % 2 else "BUY!! ### NOW!! " * 8)) for i in range(300)] + [(900, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, "k") for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 300]
    assert held and all(r["predicted"] == r["doc_id"] % 2 for r in held)
    assert len(got) == 301 and 0 < got[900]["score"] < 1
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert quality.quality_scores(none, labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_toxicity(spark, none):
    rows = [(i, numbered(i, i + 30) + (" you rottenfish now" if i % 4 == 0 else " fine")) for i in range(400)]
    rows += [(900, None), (901, "such a rottenfysh and a rotenfish"), (902, 'he said "rottenfish" quietly')]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, "k") for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert all(r["predicted"] == (i % 4 == 0) for i, r in got.items() if i < 400)
    assert got[901]["score"] > got[900]["score"] and got[902]["score"] < got[0]["score"]
    assert toxicity.toxicity_scores(none, labels).count() == 0
    assert toxicity.toxicity_scores(docs, labels.limit(0)).where("predicted = 1").count() == 0


def test_levenshtein_automaton():
    trie = toxicity.Trie(["moron", "idiot"])
    for word, found in [("moron", True), ("mroon", False), ("morn", True), ("moronx", True), ("xmoron", True),
                        ("maron", True), ("idiots", True), ("id", False), ("", False), ("mooron", True)]:
        assert (trie.within(word) is not None) is found, word


def test_toxic_words_with_accents(spark):
    """Terms are learned from the words that scoring looks for, accents and marks included."""
    bad, good = "Débile ça répugnant naïf", "été çà l'île où très"
    rows = [(i, f"{bad if i % 2 else good} mot{i} fin") for i in range(200)]
    docs = spark.createDataFrame([(i, t, "fr", "s", 1, 2, "k") for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    lexicon = toxicity.learned(docs, labels)
    assert {"débile", "répugnant"} <= set(lexicon.words) and not any(w in lexicon.words for w in ("bile", "pugnant"))
    got = toxicity.toxicity_scores(docs, labels).where("held_out").collect()
    assert all(r.predicted == r.doc_id % 2 for r in got) and len(got) > 40


def test_workers_keep_little_memory(monkeypatch):
    """Texts are hashed in small chunks, and freed memory goes back when a task's batches end."""
    texts = pa.array(["word " * 200] * 3_000 + ["long " * 100_000, None])
    chunks = list(arrays.text_chunks(texts))
    assert chunks[-1][1] == len(texts) and sum(len(c[2]) for c in chunks) == 3_500_000
    assert max(len(c[2]) for c in chunks if c[1] - c[0] > 1) <= 1 << 18
    given = []
    monkeypatch.setattr(memo, "give_back", lambda: given.append(1))
    batches = memo.tidy(lambda batches: (b for b in batches))(iter([1, 2]))
    assert next(batches) == 1 and not given and list(batches) == [2] and given == [1]


def test_cuts_of_a_run_are_merged(spark):
    """Among many near copies a run has many cuts that overlap; a document gets what they cover once."""
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("abcdefgh"), 900))
    texts = [base[:300 + 20 * i] + "".join(rng.choice(list("xyz"), 30)) + base[300 + 20 * i:] for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = suffixes.repeated_bytes(docs).collect()
    runs = defaultdict(list)
    for r in spans:
        runs[r["_id"]].append((r["start"], r["start"] + r["size"]))
    windows = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    for i, text in enumerate(texts):
        want = {p for s in range(len(text) - 199) if windows[text[s:s + 200]] > 1 for p in range(s, s + 200)}
        assert {p for a, b in runs[i] for p in range(a, b)} == want
    cuts = spark.createDataFrame([([(5, 9), (0, 4), (2, 5), (12, 14), (13, 13)],), ([(1, 2)],)], f"cuts {suffixes.CUTS}")
    got = [[tuple(c) for c in r.cuts] for r in cuts.select(suffixes.merged(F.col("cuts")).alias("cuts")).collect()]
    assert got == [[(0, 9), (12, 14)], [(1, 2)]]
