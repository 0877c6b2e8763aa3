"""Personal data: base rules, and candidate spans that boosted trees select. DataFrame functions only.

Base spans (email, ip, card, phone) follow fixed patterns and checks. Beyond them, looser
patterns propose many, overlapping candidates: spaced or bracketed addresses, numbers in
other groupings, local numbers of seven digits and more. Features of format and context of
each candidate are small integers, and boosted trees, written out as CASE expressions, score
it. The trees are fitted to what the base rules say on all documents: base
spans and rewritten copies of them (no plus sign, ``(at)``, spaced dots, local numbers) are
examples, unless they are part of a longer word; candidates apart from any base span are
counter-examples. All rewritings of a base span together count as one example. A kind's
threshold is the lowest score at which, of the held-out candidates that are no base spans, the
share of examples reaches ``precision`` (the precision of what is added, if people rewrite as
often as not) and the trees' own odds do too. Selected candidates that touch no base span, the
first ones of those that overlap, are added to the base spans.

The features have fewer than 53,000 combinations (``COMBINATIONS``), so all of them that occur
count in the fit and in the thresholds, whatever the documents.

The patterns equal plain ones but use possessive repeats and begin a run only at its start
(or where the last match ended): Java then needs neither a deep stack nor quadratic time.
Offsets are running sums in two levels, and a candidate's context is cut from the piece
before it, so the work of n matches in one text grows with n times its root.

Cases: null is the empty text, without spans. Offsets count code points, end exclusive.
Repeated rows are each answered; other columns are kept. Without examples nothing is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# The base patterns and what they look for first; parts of an address up to 255.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
OCTETS = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
# The looser patterns, and words before a span that hint at its kind.
LOOSE = {
    "email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+(?: ?(?:\(dot\)|\[dot\]) ?{LOCAL}{{1,64}}+){{0,8}}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{{1,63}}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{{1,63}}+){{1,8}}",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?: ?[.,] ?|\[\.\])[0-9]{1,3}+(?: ?[.,] ?|\[\.\])[0-9]{1,3}+(?: ?[.,] ?|\[\.\])[0-9]{1,3}+",
    "card": r"(?<![0-9])[0-9](?:[ .-]{0,2}[0-9]){11,18}+",
    "phone": r"(?<![0-9])[+(]?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}+",
}
CUES = {
    "email": r"(?:mail|contact|kontakt|correo|courriel)",
    "ip": r"(?:\bip\b|address|host|server|adresse)",
    "card": r"(?:card|visa|credit|karte|carte|tarjeta|account|iban)",
    "phone": r"(?:phone|tel|call|fax|mobil|fon\b|m.vil)",
}
#: Four digits close together, without which the three numeric kinds have no candidate.
NUMERIC = r"[0-9](?:[^0-9\p{L}]{0,3}[0-9]){3}"
DATE = r"^(?:(?:19|20)[0-9]{2}([./-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([./-])[0-9]{1,2}\2(?:19|20)[0-9]{2})$"
#: Each feature's largest value by kind; 0 where it says nothing of the kind.
LARGEST = {
    "digits": {"card": 3, "phone": 5},
    "plus": {"phone": 1},
    "paren": {"phone": 1},
    "dots": {"email": 2, "ip": 2, "card": 2, "phone": 2},
    "hyphens": {"email": 2, "card": 2, "phone": 2},
    "spaces": {"email": 2, "ip": 2, "card": 2, "phone": 2},
    "luhn": {"card": 1},
    "octets": {"ip": 1},
    "date": {"phone": 1},
    "at": {"email": 1},
    "left": {"email": 3, "ip": 3, "card": 3, "phone": 3},
    "right": {"email": 3, "ip": 3, "card": 3, "phone": 3},
    "cue": {"email": 1, "ip": 1, "card": 1, "phone": 1},
    "marked": {"email": 1, "ip": 1},
}
FEATURES = ("kind", *LARGEST)
COMBINATIONS = sum(math.prod(most.get(k, 0) + 1 for most in LARGEST.values()) for k in KINDS)
#: Characters before a span that are read for a hint.
CONTEXT = 24
SPAN = "array<struct<start:int,end:int,found:string,before:string,after:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running(steps: Column) -> Column:
    """Running sums of an array of integers, by chunks of about the root of its length: an
    append copies a chunk, never all of the sums."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))

    def add(state: Column, x: Column) -> Column:
        return F.struct((state["at"] + x).alias("at"), F.array_append(state["sums"], state["at"] + x).alias("sums"))

    def sums(values: Column) -> Column:
        return F.aggregate(values, none, add, lambda state: state["sums"])

    size = F.ceil(F.sqrt(F.size(steps))).cast("int")
    starts = F.sequence(F.lit(0), F.size(steps) - 1, size)
    chunks = F.transform(starts, lambda at: sums(F.slice(steps, at + 1, size)))

    def joined(parts: Column) -> Column:
        ends = sums(F.transform(parts, lambda p: F.element_at(p, -1)))
        return F.flatten(F.zip_with(parts, ends, lambda p, end: F.transform(p, lambda x: x + end - F.element_at(p, -1))))

    return F.when(F.size(steps) == 0, F.array().cast("array<int>")).otherwise(_let(chunks, joined))


def located(text: Column, pattern: str) -> Column:
    """Matches with their places and contexts: what lies between them, and they, add up to the text."""
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def spans(p: Column) -> Column:
        hits, gaps = p["hits"], p["gaps"]
        steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.char_length(g) + F.char_length(h))

        def span(end: Column, i: Column) -> Column:
            hit = F.get(hits, i)
            before = F.concat(F.coalesce(F.get(hits, i - 1), F.lit("")), F.get(gaps, i))
            after = F.concat(F.left(F.get(gaps, i + 1), F.lit(1)), F.coalesce(F.left(F.get(hits, i + 1), F.lit(1)), F.lit("")))
            return F.struct(
                (end - F.char_length(hit)).alias("start"),
                end.alias("end"),
                hit.alias("found"),
                F.right(before, F.lit(CONTEXT)).alias("before"),
                F.left(after, F.lit(1)).alias("after"),
            )

        return F.transform(running(steps), span)

    return F.when(F.regexp_like(text, F.lit(pattern)), _let(parts, spans)).otherwise(F.array().cast(SPAN))


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does the number pass the check digit rule?"""

    def weighed(i: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.char_length(digits) - i, F.lit(1))) - F.lit(48)
        twice = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(0), F.char_length(digits) - 1)
    total = F.aggregate(places, F.lit(0), lambda total, i: total + weighed(i))
    return F.when(digits == "", False).otherwise(total % 10 == 0)


def _valid(kind: str, found: Column) -> Column:
    match kind:
        case "ip":
            return found.rlike(OCTETS)
        case "card":
            return F.char_length(digits_of(found)).between(13, 19) & luhn(digits_of(found))
        case "phone":
            return F.char_length(digits_of(found)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    wanted = text.rlike("[0-9]") if NEEDS[kind] is None else F.contains(text, F.lit(NEEDS[kind]))
    return F.when(wanted, F.filter(located(text, BASE[kind]), lambda x: _valid(kind, x["found"]))).otherwise(F.array().cast(SPAN))


def _candidates(text: Column, kind: str) -> Column:
    wanted = text.rlike(r"@|\(at\)|\[at\]") if kind == "email" else text.rlike(NUMERIC)
    return F.when(wanted, located(text, LOOSE[kind])).otherwise(F.array().cast(SPAN))


def _occurs(found: Column, pattern: str, most: int) -> Column:
    return F.least(F.regexp_count(found, F.lit(pattern)), F.lit(most))


def _side(char: Column) -> Column:
    """Class of a neighbouring character: none or space, letter or digit, closing mark, other."""
    return F.when((char == "") | char.rlike(r"^\s"), 0).when(char.rlike(r"^[\p{L}0-9]"), 1).when(char.rlike("^[.,;:!?)]"), 2).otherwise(3)


def _band(kind: str, digits: Column) -> Column:
    """Numbers of digits that mean the same: of a card short, usual, long; of a phone local to international."""
    if kind == "card":
        return F.when(digits < 16, 1).when(digits == 16, 2).otherwise(3)
    return F.when(digits == 7, 1).when(digits == 8, 2).when(digits < 11, 3).when(digits < 13, 4).otherwise(5)


def features(kind: str, span: Column, found: Column) -> list[Column]:
    """The features of a candidate, small integers in the order of FEATURES."""
    values = {
        "digits": lambda: _band(kind, F.char_length(digits_of(found))),
        "plus": lambda: found.startswith("+"),
        "paren": lambda: found.rlike("[()]"),
        "dots": lambda: _occurs(found, r"\.", 2),
        "hyphens": lambda: _occurs(found, "-", 2),
        "spaces": lambda: _occurs(found, " ", 2),
        "luhn": lambda: luhn(digits_of(found)),
        "octets": lambda: F.regexp_replace(F.regexp_replace(found, r"[ \[\]]", ""), ",", ".").rlike(OCTETS),
        "date": lambda: found.rlike(DATE),
        "at": lambda: F.contains(found, F.lit("@")),
        "left": lambda: _side(F.right(span["before"], F.lit(1))),
        "right": lambda: _side(span["after"]),
        "cue": lambda: F.lower(span["before"]).rlike(CUES[kind]),
        "marked": lambda: found.rlike(r"\[|\((?:at|dot)"),
    }
    own = [values[f]().cast("int") if kind in most else F.lit(0) for f, most in LARGEST.items()]
    return [F.lit(KINDS.index(kind)), *own]


#: How many ways of rewriting each kind has.
WAYS = {"email": 3, "ip": 2, "card": 2, "phone": 3}


def rewritten(kind: str, found: Column) -> list[Column]:
    """A base span as people write it to escape the base patterns, or where all know the prefix."""
    digits = digits_of(found)
    match kind:
        case "email":
            at_dot = F.regexp_replace(F.regexp_replace(found, "@", " (at) "), r"\.", "(dot)")
            return [at_dot, F.regexp_replace(found, "@", "[at]"), F.regexp_replace(found, "@", " @ ")]
        case "ip":
            return [F.regexp_replace(found, r"\.", "[.]"), F.regexp_replace(found, r"\.", " . ")]
        case "card":
            ends = "(?<=[0-9])(?=(?:[0-9]{4})+$)"
            return [F.regexp_replace(digits, ends, mark) for mark in (".", "  ")]
        case _:
            national = F.regexp_replace(found, r"^\+[0-9]{1,3}[ ]?", "")
            local = F.concat(F.substring(digits, -7, 3), F.lit("-"), F.substring(digits, -4, 4))
            return [national, F.regexp_replace(found, r"^\+", "00"), local]


@dataclass(frozen=True)
class Tree:
    """A split in two, each side split in two; ``leaves`` for (low, low), (low, high), (high, low), (high, high)."""

    first: tuple[int, int]  # feature, and the largest value on the low side
    low: tuple[int, int]
    high: tuple[int, int]
    leaves: tuple[float, float, float, float]

    def score(self, x: Sequence[int]) -> float:
        side = x[self.first[0]] > self.first[1]
        feature, most = self.high if side else self.low
        return self.leaves[2 * side + (x[feature] > most)]

    def column(self, x: Sequence[Column]) -> Column:
        def split(at: tuple[int, int], low: Column, high: Column) -> Column:
            return F.when(x[at[0]] > at[1], high).otherwise(low)

        a, b, c, d = map(F.lit, self.leaves)
        return split(self.first, split(self.low, a, b), split(self.high, c, d))


@dataclass(frozen=True)
class Selector:
    prior: float
    trees: tuple[Tree, ...]
    thresholds: tuple[float, ...]  # by kind; infinite where nothing is to be added

    def column(self, x: Sequence[Column]) -> Column:
        return sum((t.column(x) for t in self.trees), F.lit(self.prior))


NOTHING = Selector(0.0, (), (math.inf,) * len(KINDS))


def boost(patterns: Sequence[tuple[Sequence[int], float, float]], rounds: int = 60, rate: float = 0.3) -> tuple[float, tuple[Tree, ...]]:
    """Boosted trees of logistic loss over (features, examples, counter-examples)."""
    import numpy as np

    x = np.array([p[0] for p in patterns], dtype=int)
    good, bad = (np.array([p[i] for p in patterns], dtype=float) for i in (1, 2))
    prior = math.log((good.sum() + 1) / (bad.sum() + 1))
    score = np.full(len(x), prior)
    cuts = [(f, int(v)) for f in range(x.shape[1]) for v in np.unique(x[:, f])[:-1]] or [(0, 0)]
    sides = np.array([x[:, f] > v for f, v in cuts])

    def best(gradient, weight, rows) -> int:
        g, h = gradient * rows, weight * rows
        high_g, high_h = sides @ g, sides @ h
        gain = high_g**2 / (high_h + 1) + (g.sum() - high_g) ** 2 / (h.sum() - high_h + 1)
        return int(np.argmax(gain))

    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = good - (good + bad) * p, (good + bad) * p * (1 - p)
        first = best(gradient, weight, np.ones(len(x)))
        parts, splits = [], []
        for side in (~sides[first], sides[first]):
            inner = best(gradient, weight, side)
            splits.append(cuts[inner])
            parts += [side & ~sides[inner], side & sides[inner]]
        leaves = tuple(float(rate * (gradient * r).sum() / ((weight * r).sum() + 1)) for r in parts)
        trees.append(Tree(cuts[first], splits[0], splits[1], leaves))
        for r, leaf in zip(parts, leaves):
            score = score + leaf * r
    return prior, tuple(trees)


def calibrate(scored: Sequence[tuple[float, float, float]], precision: float) -> float:
    """The lowest score from which on the share of examples is ``precision`` at least; infinite if none is."""
    best, good, bad = math.inf, 0.0, 0.0
    by_score: dict[float, list[float]] = {}
    for score, g, b in scored:
        at = by_score.setdefault(score, [0.0, 0.0])
        at[0] += g
        at[1] += b
    for score in sorted(by_score, reverse=True):
        good, bad = good + by_score[score][0], bad + by_score[score][1]
        if good >= 5 and good >= precision * (good + bad):
            best = score
    return best


def eased(lowest: float, scores: Sequence[float], precision: float) -> float:
    """Half way from the ``lowest`` score that is taken to the next one seen below it, as shapes a little
    unlike those seen lie in the gap, but no lower than where the trees' own odds reach ``precision``:
    a rare shape does not pass for being counted with common ones."""
    below = max([s for s in scores if s < lowest], default=-math.inf)
    return max((lowest + below) / 2 if math.isfinite(lowest) else lowest, math.log(precision / (1 - precision)))


def _touches(span: Column, others: Column) -> Column:
    """Does the span overlap another? Most that do begin where that one begins, which is seen sooner."""
    same = F.array_contains(others["start"], span["start"])
    return same | F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _apart_from(others: Column) -> Callable[[Column], Column]:
    return lambda span: ~_touches(span, others)


def with_base(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``), pii_text (null as empty) and the base spans of each kind in pii_<kind>."""
    placed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("pii_text"))
    return placed.withColumns({f"pii_{k}": base_spans(F.col("pii_text"), k) for k in KINDS})


def _embedded(span: Column) -> Column:
    """Does the span go on in a word or number beside it, as digits of a key or hash do?"""
    return F.right(span["before"], F.lit(1)).rlike("[A-Za-z0-9]") | span["after"].rlike("[A-Za-z0-9]")


def learn(docs: DataFrame, precision: float = 0.98) -> Selector:
    """Fit the selector on all of ``docs``.

    Only counts by combination of features reach the driver, at most two for each of COMBINATIONS.
    """
    picked = with_base(docs.select("doc_id", "text"))
    picked = picked.withColumn("pii_all", F.concat(*(F.col(f"pii_{k}") for k in KINDS)))

    def shape(kind: str, found: Callable[[Column], Column], example: str) -> Callable[[Column], Column]:
        def of(s: Column) -> Column:
            x = F.array(*(c.cast("int") for c in features(kind, s, found(s))))
            return F.struct(x.alias("x"), F.lit(example).alias("example"))

        return of

    parts = []
    for kind in KINDS:
        own = F.filter(f"pii_{kind}", lambda s: ~_embedded(s))
        parts.append(F.transform(own, shape(kind, lambda s: s["found"], "base")))
        for i in range(WAYS[kind]):
            way = partial(lambda s, kind, i: rewritten(kind, s["found"])[i], kind=kind, i=i)
            parts.append(F.transform(own, shape(kind, way, "rewritten")))
        apart = F.filter(_candidates(F.col("pii_text"), kind), _apart_from(F.col("pii_all")))
        parts.append(F.transform(apart, shape(kind, lambda s: s["found"], "other")))
    shapes = "array<struct<x:array<int>,example:string>>"
    held = (F.pmod(F.xxhash64("row.doc_id", F.lit(1)), F.lit(3)) == 0).alias("held")
    rows = picked.select(held, F.explode(F.concat(*parts).cast(shapes)).alias("c"))
    examples = [F.count_if(F.col("c.example") == e).alias(e) for e in ("base", "rewritten", "other")]
    counts = rows.groupBy("held", "c.x").agg(*examples).collect()
    seen = []
    for r in sorted(counts, key=lambda r: (r["held"], r["x"])):
        seen.append((r["held"], tuple(r["x"]), r["base"], r["rewritten"] / WAYS[KINDS[r["x"][0]]], r["other"]))
    fitted = [(x, base + again, other) for held, x, base, again, other in seen if not held]
    if not any(g for _, g, _ in fitted):
        return NOTHING
    prior, trees = boost(fitted)
    thresholds = []
    for k in range(len(KINDS)):
        scored = [(prior + sum(t.score(x) for t in trees), again, other) for held, x, _, again, other in seen if held and x[0] == k]
        thresholds.append(eased(calibrate(scored, precision), [s for s, _, _ in scored], precision))
    return Selector(prior, trees, tuple(thresholds))


def _wanted(selector: Selector, kind: str) -> Callable[[Column], Column]:
    def wanted(span: Column) -> Column:
        x = F.array(*(c.cast("int") for c in features(kind, span, span["found"])))
        score = _let(x, lambda x: selector.column([x[i] for i in range(len(FEATURES))]))
        return ~_touches(span, F.col("pii_base")) & (score >= selector.thresholds[KINDS.index(kind)] - 1e-6)

    return wanted


def find(docs: DataFrame, selector: Selector) -> DataFrame:
    """row (all columns of ``docs``), pii_text, pii_<kind> (base spans) and pii_added_<kind> (selected candidates)."""
    found = with_base(docs)
    found = found.withColumn("pii_base", F.concat(*(F.col(f"pii_{k}") for k in KINDS)))
    added = {}
    for i, kind in enumerate(KINDS):
        if math.isinf(selector.thresholds[i]):
            added[f"pii_added_{kind}"] = F.array().cast(SPAN)
            continue
        wanted = _wanted(selector, kind)
        added[f"pii_added_{kind}"] = F.filter(_candidates(F.col("pii_text"), kind), wanted)
    found = found.withColumns(added)
    # of candidates of different kinds that overlap, that of the kind listed first stays
    taken = F.col("pii_added_email")
    apart = {}
    for kind in KINDS[1:]:
        apart[f"pii_added_{kind}"] = F.filter(F.col(f"pii_added_{kind}"), _apart_from(taken))
        taken = F.concat(taken, F.col(f"pii_added_{kind}"))
    return found.withColumns(apart)


def _named(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])


def _tagged(kind: str) -> Callable[[Column], Column]:
    tag = F.lit(f"[{kind.upper()}]").alias("tag")
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), tag)


def _listed(prefixes: Sequence[str]) -> Column:
    """kind:start:end of the spans, by kind, then start, joined by commas."""
    parts = []
    for kind in KINDS:
        spans = F.array_sort(F.concat(*(F.col(f"{p}{kind}") for p in prefixes)))
        parts.append(F.transform(spans, _named(kind)))
    return F.array_join(F.concat(*parts), ",")


def digests(docs: DataFrame, selector: Selector) -> DataFrame:
    """doc_id, base counts, the digest of the base spans, and all spans, of every row of ``docs``."""
    found = find(docs.select("doc_id", "text"), selector)
    counts = [F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.sha2(_listed(["pii_"]), 256).alias("base_sha256")
    return found.select("row.doc_id", *counts, base, _listed(["pii_", "pii_added_"]).alias("spans"))


def redact(docs: DataFrame, selector: Selector) -> DataFrame:
    """``docs`` with each span, base or selected, replaced by its kind in brackets; all columns as before."""
    found = find(docs, selector)
    every = F.concat(*(F.transform(F.col(f"{p}{k}"), _tagged(k)) for p in ("pii_", "pii_added_") for k in KINDS))
    found = found.withColumn("pii_sorted", F.array_sort(every))
    text, begin = F.col("pii_text"), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        inside = s["start"] < state["at"]  # overlaps the span before, which it only prolongs
        parts = F.when(inside, state["parts"]).otherwise(F.concat(state["parts"], F.array(gap, s["tag"])))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), parts.alias("parts"))

    def join(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.char_length(text)))

    clean = F.when(F.size("pii_sorted") == 0, F.col("row.text")).otherwise(F.aggregate("pii_sorted", begin, step, join))
    return found.select(*((clean if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
