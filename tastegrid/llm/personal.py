"""Personal data in texts: base patterns, and spans that weak labelers and a classifier add.

Everything runs as DataFrame expressions.  Four base patterns give the base spans.
Candidates are all matches of the base patterns with enough digits, those their
checks drop included, and matches of wider patterns (spelled-out addresses, dots
in brackets, numbers run together with their neighbours).  Six labelers vote yes,
no or nothing on each candidate: two by pattern (shape, check digits or ranges),
two by gazetteer (issuers, domains and calling codes; cue and decoy words before
the span), two by context (what touches the span; what number goes on after it).

Candidates are counted by kind, votes and form.  These cells are bounded by the
labelers, not by the corpus.  On them, expectation-maximisation estimates how
reliable each labeler is and how likely each cell; a logistic regression on votes
and form is then fitted to these likelihoods.  What was assumed of a labeler
weighs as much as what is seen, at every size.  A candidate scored ``LEAST`` or
more that touches no base span and no earlier addition is added to the spans.

Positions are code points.  Null text is empty: zeros and the digest of nothing.
Without candidates nothing is fitted and nothing added.  Rows that repeat get
the same result each and count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from operator import eq, or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.tables import written

KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# Possessive and anchored at the start of a run: the matches are those of the plain
# patterns, found in one pass however long a run is.
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text with digits must hold for a pattern to be tried.
TRIED = {"ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_DOT = r"(?: ?[\[({]dot[\])}] ?| dot |\.)"
_AT_SIGN = r"(?i)[\[({]at[\])}]"
_AT = r" ?[\[({]at[\])}] ?| ?@ ?"
WIDER = {
    "email": (rf"(?i)(?<![{LOCAL}])[{LOCAL}]++(?:(?:{_AT})[{LABEL}]++(?:{_DOT}[{LABEL}]++)++"
              rf"| at [{LABEL}]++(?: dot [{LABEL}]++)++)"),
    "ip": r"(?i)(?<![0-9.])[0-9]{1,3}+(?: ?(?:[\[({](?:\.|dot)[\])}]| dot ) ?[0-9]{1,3}+){3}(?![0-9])",
    "card": (r"(?<![0-9A-Za-z._/-])(?:[0-9]{14,19}+|[0-9]{4}(?:[._/ -]{1,3}[0-9]{4}){3}|"
             r"3[0-9]{3}[._/ -]{1,3}[0-9]{6}[._/ -]{1,3}[0-9]{5})(?![0-9A-Za-z]|[._/-][0-9])"),
    "phone": (r"(?<![0-9A-Za-z+.)-])(?:(?:\+|00)[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])"
              r"[0-9]{3,4}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
}
WIDER_TRIED = {"ip": r"(?i)[0-9] ?(?:[\[({]|dot )", "card": "[0-9]{14}|[0-9]{4}[._/ -]{1,3}[0-9]{4}",
               "phone": r"[0-9][ .)-]{1,2}[0-9]{3,4}[ .-][0-9]{4}"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
# Digits that a match needs to be a candidate.
LEAST_DIGITS = {"email": 0, "ip": 4, "card": 13, "phone": 7}
LEAST = 0.8
NEAR = 32
BLOCK = 256

# Gazetteers.
DOMAINS = ("com", "org", "net", "edu", "gov", "int", "info", "io", "co", "eu", "de", "fr", "es", "it", "uk", "us", "ch",
           "at", "nl", "be", "pt", "mx", "ar", "ca", "au", "jp", "cn", "in", "br", "ru", "se", "no", "dk", "fi", "pl")
CUES = {
    "email": "mail|contact|write|reach|adresse|correo|schreib",
    "ip": r"\bip\b|address|host|server|gateway|adresse|login|client",
    "card": "card|visa|master|amex|credit|debit|payment|carte|tarjeta|karte",
    "phone": "phone|call|tel|fax|mobile|cell|whatsapp|anruf|appel|llam|handy",
}
DECOYS = "order|invoice|version|serial|isbn|token|sku|license|licence|release|build|commit|sha|uuid|tracking"
CODES = ("1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-8]|22[0-9]|23[0-9]|24[0-9]|25[0-8]|26[0-9]|"
         "29[0-9]|35[0-9]|37[0-9]|38[0-9]|42[0-9]|50[0-9]|59[0-9]|67[0-9]|68[0-9]|85[0-9]|88[06]|96[0-9]|97[0-9]|99[2-8]")

#: Labelers, and what is assumed of them: (yes, no) of a true span and of any other; the rest is silence.
LABELERS = {
    "shape": ((0.90, 0.05), (0.45, 0.50)),
    "check": ((0.97, 0.01), (0.15, 0.83)),
    "issuer": ((0.70, 0.02), (0.30, 0.15)),
    "cue": ((0.20, 0.02), (0.02, 0.25)),
    "edges": ((0.93, 0.05), (0.60, 0.38)),
    "sequel": ((0.01, 0.03), (0.01, 0.30)),
}
VOTES = ("yes", "no", "none")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern: array of (start, end, found, before, after).

    Start and end are code points; before and after are at most ``NEAR``
    characters up to the neighbouring match.  The lengths are summed up in
    blocks, so the work does not grow with the square of the matches.
    """
    def summed(block: Column, start: Column) -> Column:
        empty = F.slice(F.transform(block, lambda s: F.struct(
            F.lit(0).alias("start"), F.lit(0).alias("end"), s["found"].alias("found"), s["before"].alias("before"),
            s["after"].alias("after"))), 1, 0)
        return F.aggregate(
            block, F.struct(start.alias("at"), empty.alias("out")),
            lambda acc, s: F.struct(
                (acc["at"] + s["gap"] + s["width"]).alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["width"]).alias("end"),
                    s["found"].alias("found"), s["before"].alias("before"), s["after"].alias("after")))).alias("out")),
            lambda acc: acc["out"])

    def placed(x: Column) -> Column:
        n = F.size(x["m"])
        rows = F.zip_with(
            F.zip_with(F.slice(x["p"], 1, n), F.slice(x["p"], 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            x["m"], lambda p, m: F.struct(
                F.char_length(p["a"]).alias("gap"), F.char_length(m).alias("width"), m.alias("found"),
                F.right(p["a"], F.lit(NEAR)).alias("before"), F.left(p["b"], F.lit(NEAR)).alias("after")))
        return let(rows, lambda r: let(
            F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                        lambda b: F.slice(r, b * BLOCK + 1, BLOCK)),
            lambda blocks: F.flatten(F.zip_with(blocks, F.slice(F.aggregate(
                blocks, F.array(F.lit(0)),
                lambda sums, block: F.concat(sums, F.array(F.element_at(sums, -1) + F.aggregate(
                    block, F.lit(0), lambda a, s: a + s["gap"] + s["width"])))), 1, F.size(blocks)), summed))))

    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return let(both, lambda x: F.when(F.size(x["m"]) > 0, placed(x)))


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def passes(kind: str, found: Column) -> Column:
    """The check of a base pattern's match."""
    count = F.char_length(digits_of(found))
    if kind == "ip":
        return found.rlike(rf"\A{BYTE}(?:\.{BYTE}){{3}}\z")
    if kind == "card":
        return count.between(14, 19) & F.call_function("luhn_check", digits_of(found))
    return count.between(10, 15) if kind == "phone" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "yes").when(no, "no").otherwise("none")


def votes(kind: str, s: Column) -> dict[str, Column]:
    """Every labeler's vote on a candidate."""
    found, digits = s["found"], digits_of(s["found"])
    plain = F.regexp_replace(F.regexp_replace(found, r"(?i) ?[\[({]?\b(?:dot)\b[\])}]? ?|[\[({]\.[\])}]", "."),
                             r"(?i) ?[\[({]at[\])}] ?| at | ?@ ?", "@")
    shape = {
        "email": plain.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\z"),
        "ip": F.regexp_replace(plain, " ", "").rlike(r"\A[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z"),
        "card": found.rlike(r"\A(?:[0-9]{13,19}|[0-9]{4}([._/ -]{1,3})[0-9]{4}\1[0-9]{4}\1[0-9]{4}|"
                            r"[0-9]{4}([._/ -])[0-9]{6}\2[0-9]{5})\z"),
        "phone": found.rlike(r"\A(?:(?:\+|00)[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-]?)?"
                             r"[0-9]{3,4}[ .-]?[0-9]{3,4}(?:[ .-]?[0-9]{2,4})?\z"),
    }[kind]
    check = {
        "email": ~plain.rlike(r"\.\.|[.-]@|@[.-]|-\.|\.-"),
        "ip": F.regexp_replace(plain, " ", "").rlike(rf"\A{BYTE}(?:\.{BYTE}){{3}}\z"),
        "card": F.char_length(digits).between(13, 19) & F.call_function("luhn_check", digits),
        "phone": F.char_length(digits).between(10, 15) & ~digits.rlike(r"([0-9])\1{6}"),
    }[kind]
    issuer = {
        "email": _vote(F.lower(F.regexp_extract(plain, r"([A-Za-z]+)\z", 1)).isin(*DOMAINS), plain.rlike(r"[0-9]\z")),
        "ip": _vote(plain.rlike(r"\A(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\."), plain.rlike(r"\A0")),
        "card": _vote(digits.rlike(r"\A(?:4|5[1-5]|2[2-7]|3[04-8]|6[0245])"), digits.rlike(r"\A0")),
        "phone": _vote(found.rlike(rf"\A(?:\+|00)(?:{CODES})"), found.rlike(r"\A(?:\+|00)?0")),
    }[kind]
    before = F.lower(s["before"])
    glued = F.regexp_extract(s["before"], r"(?s)(.)\z", 1).rlike(r"[0-9A-Za-z_=\"'/#]") | s["after"].rlike(r"\A[0-9A-Za-z_=/]")
    goes_on = s["after"].rlike(r"\A ?[.,:/-]?[0-9]|\A[.:/-][0-9A-Za-z]") | s["before"].rlike(r"[0-9][ .:/-]?\z")
    return {"shape": _vote(shape, ~shape), "check": _vote(check, ~check), "issuer": issuer,
            "cue": _vote(before.rlike(CUES[kind]), before.rlike(DECOYS)), "edges": _vote(~glued, glued),
            "sequel": _vote(F.lit(False), goes_on)}


def candidate(kind: str, s: Column, origin: Column) -> Column:
    """(start, kind, end, origin, cell): the cell holds votes and form as words."""
    said = votes(kind, s)
    digits = F.char_length(digits_of(s["found"]))
    parting = F.regexp_extract(s["found"], r"[0-9]([^0-9])", 1)
    parted = F.when(parting == "", "no").when(parting == " ", "space").when(parting == ".", "dot").otherwise("other")
    form = [F.concat(F.lit("origin="), origin), F.concat(F.lit("parted="), parted),
            F.concat(F.lit("digits="), F.least(digits, F.lit(20)).cast("string"))]
    words = [F.lit(f"kind={kind}"), *(F.concat(F.lit(f"{name}="), said[name]) for name in LABELERS), *form]
    return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"),
                    origin.alias("origin"), F.concat_ws("|", *words).alias("cell"))


def found_spans(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``also``, ``base`` spans and ``candidates`` of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))

    kinds = "array<struct<start:int,kind:int,end:int,origin:string,cell:string>>"
    none = F.array().cast(kinds)

    def matched(kind: str, tried: Column) -> Column:
        enough = F.filter(located(text, BASE[kind]), lambda s: F.char_length(digits_of(s["found"])) >= LEAST_DIGITS[kind])
        checked = F.transform(enough, lambda s: candidate(
            kind, s, F.when(passes(kind, s["found"]), "base").otherwise("dropped")))
        return F.coalesce(F.when(tried, checked).cast(kinds), none)

    def wider(kind: str, tried: Column) -> Column:
        spans = F.transform(located(text, WIDER[kind]), lambda s: candidate(kind, s, F.lit("wider")))
        return F.coalesce(F.when(tried, spans).cast(kinds), none)

    # most texts are told by a few quick looks: an at sign, brackets, " dot ", a digit
    has = lambda *parts: reduce(or_, [F.contains(text, F.lit(p)) for p in parts])
    mails = F.concat(matched("email", has("@")),
                     wider("email", has("@") | (has(" dot ", " Dot ", " DOT ")) | (has("[", "(", "{") & text.rlike(_AT_SIGN))))
    numbers = F.concat(*[part for kind in KINDS[1:] for part in (
        matched(kind, text.rlike(TRIED[kind])), wider(kind, text.rlike(WIDER_TRIED[kind])))])
    all_of = F.concat(mails, F.when(text.rlike("[0-9]"), numbers).otherwise(none))

    def split_up(found: Column) -> Column:
        base = F.filter(found, lambda c: c["origin"] == "base")
        return let(base, lambda b: F.struct(
            F.array_sort(F.transform(b, lambda c: F.struct(c["start"], c["kind"], c["end"]))).alias("base"),
            F.filter(found, lambda c: (c["origin"] == "base") | ~F.exists(
                b, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"]))).alias("candidates")))

    return (docs.select("doc_id", *also, let(all_of, split_up).alias("_f"))
            .select("doc_id", *also, "_f.base", "_f.candidates"))


def cell_counts(found: DataFrame) -> DataFrame:
    """(cell, n) of all candidates."""
    return found.select(F.explode("candidates.cell").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))


def _words(cells: list[str]) -> list[dict[str, str]]:
    return [dict(w.split("=", 1) for w in cell.split("|")) for cell in cells]


def reliabilities(cells: list[str], counts: list[int], rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation on the votes: (likelihood of each cell, P(vote | labeler, truth)).

    The second has the axes labeler, truth (other, true), vote.  Each kind has
    its own share of true spans.
    """
    words = _words(cells)
    n = np.array(counts, dtype=float)
    vote = np.array([[VOTES.index(w[name]) for name in LABELERS] for w in words])
    kind = np.array([KINDS.index(w["kind"]) for w in words])
    assumed = np.array([[[y, no, 1 - y - no] for y, no in (LABELERS[name][1], LABELERS[name][0])] for name in LABELERS])
    theta, share = assumed.copy(), np.full(len(KINDS), 0.5)
    of_kind = np.bincount(kind, n, minlength=len(KINDS))
    likely = np.zeros(len(n))
    for _ in range(rounds):
        log = np.log(np.stack([1 - share, share]))[:, kind]
        for i in range(len(LABELERS)):
            log = log + np.log(theta[i][:, vote[:, i]])
        likely = 1 / (1 + np.exp(log[0] - log[1]))
        mass = np.stack([n * (1 - likely), n * likely])
        for i in range(len(LABELERS)):
            seen = np.stack([np.bincount(vote[:, i], m, minlength=len(VOTES)) for m in mass])
            total = seen.sum(1, keepdims=True)
            theta[i] = (assumed[i] * n.sum() + seen) / (n.sum() + total)
        share = (0.5 * of_kind + np.bincount(kind, mass[1], minlength=len(KINDS))) / np.maximum(2 * of_kind, 1e-9)
        share = np.clip(share, 0.01, 0.99)
    return likely, theta


def span_classifier(cells: list[str], counts: list[int], likely: np.ndarray, rounds: int = 30) -> dict[str, float]:
    """Weight of each word of a cell: logistic regression on the likelihoods, by Newton steps."""
    names = sorted({w for cell in cells for w in cell.split("|")})
    place = {w: i + 1 for i, w in enumerate(names)}
    x = np.zeros((len(cells), len(names) + 1))
    x[:, 0] = 1
    for row, cell in enumerate(cells):
        x[row, [place[w] for w in cell.split("|")]] = 1
    n = np.array(counts, dtype=float)
    n = n / n.sum() * 1000  # the ridge weighs alike at every size
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (n * (likely - p)) - w)
        w += np.clip(step, -2, 2)
    return {"": float(w[0])} | {name: float(w[i]) for name, i in place.items()}


def fitted(found: DataFrame) -> dict[str, float]:
    """Weights of the span classifier; empty without candidates.

    The cells on the driver are bounded: kinds, votes and forms multiply to a
    fixed number.
    """
    rows = cell_counts(found).orderBy("cell").collect()
    if not rows:
        return {}
    cells, counts = [r.cell for r in rows], [r.n for r in rows]
    return span_classifier(cells, counts, reliabilities(cells, counts)[0])


def with_added(found: DataFrame, weights: dict[str, float], least: float = LEAST) -> DataFrame:
    """Add ``added``: the candidates that the classifier takes, first come first, apart from each other."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if not weights:
        return found.withColumn("added", none)
    table = F.create_map(*[F.lit(x) for item in weights.items() if item[0] for x in item])
    least_sum = float(np.log(least / (1 - least)) - weights[""])

    def taken(c: Column) -> Column:
        score = F.aggregate(F.split(c["cell"], r"\|"), F.lit(0.0),
                            lambda a, w: a + F.coalesce(F.try_element_at(table, w), F.lit(0.0)))
        return (c["origin"] != "base") & (score >= least_sum)

    ordered = F.array_sort(F.transform(F.filter("candidates", taken), lambda c: F.struct(c["start"], c["kind"], c["end"])))
    apart = F.aggregate(ordered, F.struct(F.lit(-1).alias("to"), none.alias("out")),
                        lambda acc, s: F.when(s["start"] >= acc["to"], F.struct(
                            s["end"].alias("to"), F.concat(acc["out"], F.array(s)).alias("out"))).otherwise(acc),
                        lambda acc: acc["out"])
    return found.withColumn("added", apart)


def listed(spans: Column) -> Column:
    """kind:start:end of spans in their order, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_spans(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    found = written(found_spans(docs), "personal")
    rows = with_added(found, fitted(found), least)
    counts = [F.size(F.filter("base.kind", partial(eq, i))).cast("long").alias(f"n_{kind}")
              for i, kind in enumerate(KINDS)]
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


def masked_texts(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents with every span of the text replaced by its kind in brackets; overlapping spans go as one."""
    rest = tuple(c for c in docs.columns if c != "doc_id")
    rows = docs.select("doc_id", *[c for c in rest if c != "text"], F.coalesce("text", F.lit("")).alias("text"))
    named = {f"_c{i}": c for i, c in enumerate(rest)}
    plain = rows.select("doc_id", "text", *[F.col(c).alias(n) for n, c in named.items()])
    found = written(found_spans(plain, ("text", *(n for n, c in named.items() if c != "text"))), "personal-texts")
    spans = with_added(found, fitted(found), least).withColumn("_s", F.array_sort(F.concat("base", "added")))
    kinds = F.array(*map(F.lit, KINDS))
    cut = F.aggregate("_s", F.struct(F.lit(0).alias("to"), F.lit("").alias("out")), lambda acc, s: F.when(
        s["start"] >= acc["to"], F.struct(s["end"].alias("to"), F.concat(
            acc["out"], F.substr(F.col("text"), acc["to"] + 1, s["start"] - acc["to"]), F.lit("["), kinds[s["kind"]],
            F.lit("]")).alias("out"))).otherwise(F.struct(F.greatest(acc["to"], s["end"]).alias("to"), acc["out"].alias("out"))))
    whole = let(cut, lambda c: F.concat(c["out"], F.substr(F.col("text"), c["to"] + 1, F.char_length("text"))))
    back = {c: F.col(n) for n, c in named.items() if c != "text"} | {"doc_id": F.col("doc_id"), "text": whole}
    return spans.select(*[back[c].alias(c) for c in docs.columns])
