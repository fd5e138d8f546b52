"""Toxicity scores from a learned lexicon, misspellings included.

Terms are whole words and word beginnings (stems) that labelled documents show
to mark toxic text: their share of toxic documents is tested against the overall
share, with the error divided over all candidate terms, and must reach
``PRECISION``.  A stem goes if a shorter one is as precise.  The terms form a trie.  A Levenshtein automaton of each unusual
word walks the trie and finds whole-word terms of five letters or more within one
edit; spellings that clean labelled documents use are no match.

Each match weighs as much as its term (near spellings: as all of them) proved
right on the labelled sample, less if the words around it quote rather than abuse.  Weights combine as
independent evidence: score = 1 - product of (1 - weight).

Null and empty texts have no match and score the rate of toxic documents without
a match.  Without labels there are no terms.  Repeated rows are scored one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.memo import Memo
from tastegrid.llm.samples import FIT_ROWS, fit_sample, held_out
from tastegrid.llm.tables import written

THRESHOLD = 0.7
MOST_TERMS = 2000
PRECISION = 0.75
STEM_LENGTHS = (4, 5, 6, 7, 8)
ERROR = 0.05
CLEAN_SHARE = 0.001  # of clean documents may be scored toxic in the sample
LEAST_WEIGHTS = (0.75, 0.8, 0.85, 0.9, 0.95, 0.98)
FUZZY_LENGTH = 5
FUZZY_WEIGHT = 0.9  # misspellings are sought of terms that are this precise
CONTEXT = 6
MEMO_WORDS = 400_000
# Signs of quotation around a term.
REPORTING = frozenset("said says say called calls quote quoted quotes wrote writes term word phrase saying "
                      "reported accused sagte nannte schrieb wort dit appelle mot dijo palabra llamado".split())
OPENING, CLOSING = "“«„‘", "”»“’"
WORDS = re.compile(r"\w+")
NONE = ("", 0.0)


class Trie:
    """Terms as nested dicts; the key "" holds a term's end."""

    def __init__(self, terms: list[str]):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term

    def prefix(self, word: str) -> str | None:
        """The longest term that begins the word."""
        node, best = self.root, None
        for letter in word:
            node = node.get(letter)
            if node is None:
                break
            best = node.get("", best)
        return best

    def within(self, word: str, edits: int = 1) -> str | None:
        """A term within so many edits of the word, by intersection with its Levenshtein automaton.

        A state is the set of (letters read, edits used) the automaton can be in.
        """
        size = len(word)
        stack = [(self.root, frozenset((i, i) for i in range(edits + 1)))]
        while stack:
            node, state = stack.pop()
            if "" in node and any(size - i + e <= edits for i, e in state):
                return node[""]
            for letter, child in node.items():
                if not letter:
                    continue
                after = set()
                for i, e in state:
                    if e < edits:
                        after.add((i, e + 1))          # the term has a letter more
                        if i < size:
                            after.add((i + 1, e + 1))  # another letter
                    for skip in range(edits - e + 1):  # the word has letters more
                        if i + skip < size and word[i + skip] == letter:
                            after.add((i + skip + 1, e + skip))
                if after:
                    stack.append((child, frozenset(after)))
        return None


@dataclass
class Lexicon:
    """Terms and what their matches weigh."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    clean: set[str] = field(default_factory=set)
    near: float = 0.5
    base: float = 0.05
    quoted: float = 0.3

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """Finds the lexicon's terms in texts."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.stems = Trie(list(lexicon.stems))
        near = [w for w in lexicon.words if len(w) >= FUZZY_LENGTH and lexicon.words[w] >= FUZZY_WEIGHT]
        self.near = Trie(near)
        # one edit leaves the first or the second half of a term as it is
        around = [(w, len(w) + d) for w in near for d in (-1, 0, 1)]
        self.heads = {(w[:len(w) // 2], size) for w, size in around}
        self.tails = {(w[(len(w) + 1) // 2:], size) for w, size in around}
        self.cuts = {size: (sorted({len(h) for h, n in self.heads if n == size}),
                            sorted({len(t) for t, n in self.tails if n == size})) for _, size in around}
        self.begins = {stem[:min(STEM_LENGTHS)] for stem in lexicon.stems}
        self.kinds = Memo(self.kind, MEMO_WORDS)

    def kind(self, word: str) -> tuple[str, float]:
        """(word, stem, near or the empty text; weight)."""
        lexicon = self.lexicon
        if word in lexicon.words:
            return "word", lexicon.words[word]
        if word[:min(STEM_LENGTHS)] in self.begins:
            stem = self.stems.prefix(word)
            if stem:
                return "stem", lexicon.stems[stem]
        size = len(word)
        heads, tails = self.cuts.get(size, ((), ()))
        for n in heads:
            if (word[:n], size) in self.heads:
                return self.nearly(word)
        for n in tails:
            if (word[size - n:], size) in self.tails:
                return self.nearly(word)
        return NONE

    def nearly(self, word: str) -> tuple[str, float]:
        if word not in self.lexicon.clean and self.near.within(word):
            return "near", self.lexicon.near
        return NONE

    def matches(self, text: str) -> list[tuple[str, str, float, bool]]:
        """(kind, spelling, weight, quoted) of every match in the text."""
        lower = text.lower()
        words = WORDS.findall(lower)
        kinds = list(map(self.kinds.__getitem__, words))
        if kinds.count(NONE) == len(kinds):
            return []
        spans = [m.span() for m in WORDS.finditer(lower)]
        out = []
        for i, (kind, weight) in enumerate(kinds):
            if kind:
                around = words[max(0, i - CONTEXT):i] + words[i + 1:i + 1 + CONTEXT]
                left = lower[spans[max(0, i - CONTEXT)][0]:spans[i][0]]
                right = lower[spans[i][1]:spans[min(len(words) - 1, i + CONTEXT)][1] + 1]
                out.append((kind, words[i], weight, quotes(left, right) or not REPORTING.isdisjoint(around)))
        return out

    def score(self, text: str) -> float:
        rest = 1 - self.lexicon.base
        for _, _, weight, quoted in self.matches(text):
            rest *= 1 - weight * (self.lexicon.quoted if quoted else 1)
        return 1 - rest


def quotes(left: str, right: str) -> bool:
    """Whether a quotation that opens before the term closes after it."""
    if left.count('"') % 2 == 1 and '"' in right:
        return True
    return any(left.rfind(a) > left.rfind(b) and b in right for a, b in zip(OPENING, CLOSING, strict=True)
               if a in left)


def term_counts(sample: DataFrame) -> DataFrame:
    """term, stem, toxic and all: documents of the sample with each word and word beginning.

    Words are found as the matcher finds them.
    """
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sorted(set(WORDS.findall(t.lower()))) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.list_(pa.string()))],
                                             ["doc_id", "y", "words"])

    one = (sample.select("doc_id", "y", "text").mapInArrow(words, "doc_id long, y int, words array<string>")
           .select("y", F.explode("words").alias("word"), "doc_id"))
    whole = one.select("doc_id", "y", F.col("word").alias("term"), F.lit(False).alias("stem"))
    begins = F.explode(F.array(*(F.when(F.length("word") >= n, F.substring("word", 1, n))
                                 for n in STEM_LENGTHS)))
    stems = one.select("doc_id", "y", begins.alias("term"), F.lit(True).alias("stem")).where(
        "term is not null").distinct()
    return whole.unionByName(stems).groupBy("term", "stem").agg(F.sum("y").alias("toxic"),
                                                                F.count(F.lit(1)).alias("docs"))


def significant_terms(counts: DataFrame, base: float, most: int = MOST_TERMS) -> DataFrame:
    """Terms whose share of toxic documents is beyond chance; at most ``most``.

    The chance of so many toxic documents is at most exp(-n * KL(share, base)).
    """
    share = F.col("toxic") / F.col("docs")
    other = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    evidence = F.col("docs") * (share * F.log(share / base) + other)
    tried = counts.agg(F.count(F.lit(1)).alias("tried"))
    return (counts.where((F.col("toxic") > 0) & (share >= max(PRECISION, base)) & (F.length("term") >= 4))
            .withColumn("evidence", evidence).crossJoin(F.broadcast(tried))  # one row
            .where(F.col("evidence") >= F.log(F.col("tried") / ERROR))
            .orderBy(F.col("evidence").desc(), "term", "stem").limit(most))


def learned(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 3, fold: int = 1,
            most: int = FIT_ROWS) -> Lexicon:
    """Lexicon of a bounded sample of labelled rows outside the held-out fold."""
    sample = written(fit_sample(docs, labels, label, parts, fold, most), "toxicity-sample")  # read several times
    rates = sample.agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    n, toxic = rates["n"] or 0, rates["toxic"] or 0
    if not toxic or toxic == n:
        return Lexicon(base=(toxic + 0.5) / (n + 1) if n else 0.5)
    terms = significant_terms(written(term_counts(sample), "toxicity-terms"), toxic / n).collect()  # at most MOST_TERMS
    weigh = lambda t: (t["toxic"] + 0.5) / (t["docs"] + 1)
    words = {t["term"]: weigh(t) for t in terms if not t["stem"]}
    stems: dict[str, float] = {}
    for t in sorted((t for t in terms if t["stem"]), key=lambda t: len(t["term"])):
        shorter = [stems[t["term"][:n]] for n in STEM_LENGTHS if t["term"][:n] in stems]
        if weigh(t) > max(shorter, default=0.0):
            stems[t["term"]] = weigh(t)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Lexicon(words, stems).matcher()
        for batch in batches:
            got = [[f"{k}:{w}" for k, w, _, _ in matcher.matches(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.string()))],
                                             ["y", "found"])

    # kinds and near spellings of a bounded sample
    seen = sample.select("y", "text").mapInArrow(found, "y int, found array<string>").collect()
    clean = {f.split(":", 1)[1] for r in seen if not r["y"] for f in r["found"] if f.startswith("near:")}
    near = [r["y"] for r in seen if any(f.startswith("near:") for f in r["found"])
            and not any(f[:5] in ("word:", "stem:") for f in r["found"])]
    none = [r["y"] for r in seen if not r["found"]]
    # one near spelling alone never decides: unseen spellings of clean texts come near terms too
    weight = min(0.6, (sum(near) + 0.5) / (len(near) + 1)) if near else 0.5
    lexicon = Lexicon(words, stems, clean, weight, (sum(none) + 0.5) / (len(none) + 1))
    # the laxest terms that leave clean documents of the sample alone
    for least in LEAST_WEIGHTS:
        lexicon.words = {t: w for t, w in words.items() if w >= least}
        lexicon.stems = {t: w for t, w in stems.items() if w >= least}
        kind = lexicon.matcher().kind
        wrong = sum(rest_of(kind(f.split(":", 1)[1])[1] for f in r["found"]) <= 1 - THRESHOLD
                    for r in seen if not r["y"])
        if wrong <= CLEAN_SHARE * (n - toxic):
            break
    return lexicon


def rest_of(weights: Iterator[float]) -> float:
    """Chance that no match of these weights is right."""
    rest = 1.0
    for weight in weights:
        rest *= 1 - weight
    return rest


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    lexicon = docs.sparkSession.sparkContext.broadcast(learned(docs, labels))  # at most MOST_TERMS terms

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.value.matcher()
        for batch in batches:
            got = [matcher.score(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())],
                                             ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, score double")
    return rows.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
