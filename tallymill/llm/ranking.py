"""Quality of texts, learned from preference pairs (Bradley-Terry).

A pair says that one text is better than another. The chance of that is the logistic function of
the difference of their scores, and a score is linear in the features of a text; so the weights
come from logistic regression on feature differences, without intercept. Scores of labelled texts
then give the cut: the quantile of theirs that separates good from bad with the fewest mistakes.

Features tell nothing of a language: shares of characters by class, of repeated words and lines,
lengths. Cases: a null text is empty, an empty text has features like any other; texts of any
length are read whole. An id that several labelled rows share teaches once, with its least
features, and not at all if its labels differ. Without labels of both kinds every score is
``UNKNOWN``. Repeated rows are each answered; further columns are ignored unless named as keys.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.llm.common import per_batch, texts
from tallymill.operators.keys import dense_key
from tallymill.session import materialise

#: The score of the texts that stand just at the learned cut.
CUT = 0.3
UNKNOWN = 0.5
BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")  # words without a letter or digit

_KINDS = np.zeros(256, dtype=np.int64)  # class of each byte of a text in UTF-8
_KINDS[ord("a") : ord("z") + 1] = 1
_KINDS[0x80:] = 1
_KINDS[ord("A") : ord("Z") + 1] = 2
_KINDS[ord("0") : ord("9") + 1] = 3
for _c in b" \t\n\r\f\v":
    _KINDS[_c] = 4
for _c in b".,;:'\"-()":
    _KINDS[_c] = 5
for _c in b"!?":
    _KINDS[_c] = 6
N_KINDS = 7  # 0: other signs

FEATURES = (
    *(f"{how}_{what}" for what in ("signs", "lower", "upper", "digits", "blanks", "points", "calls", "repeats", "old_words", "bare", "old_lines") for how in ("share", "root")),
    "log_words",
    "few_words",
    "word_length",
    "log_line",
)


def features(text: str) -> list[float]:
    """What ``FEATURES`` names; shares also by their square root, in which small ones show."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    kinds = np.bincount(_KINDS[raw], minlength=N_KINDS) / max(len(raw), 1)
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    shares = [
        *kinds,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(words)) / n if words else 0.0,
        len(BARE.findall(text)) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
    ]
    both = [y for x in shares for y in (x, x**0.5)]
    per_line = n / max(len(lines), 1)
    return [*both, np.log1p(len(words)), 1 / (1 + len(words)), np.log1p(len(text) / n), np.log1p(per_line)]


@dataclass(frozen=True)
class Ranker:
    """Scores of texts: the larger, the better; ``cut`` parts good from bad."""

    weights: tuple[float, ...] = ()
    cut: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ np.array(self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, ``CUT`` at the cut."""
        if not self.weights:
            return np.full(len(x), UNKNOWN)
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + np.log(CUT / (1 - CUT)), -700, 700)))


NOTHING = Ranker()


def with_features(docs: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys`` and the features of every text, without a shuffle."""
    schema = docs.select(*keys).schema.add("x", T.ArrayType(T.DoubleType()))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([features(t) for t in texts(batch)], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), found], names=[*keys, "x"])

    return per_batch(docs.select(*keys, "text"), measure, schema)


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, label: every labelled id once.

    ``labels`` has doc_id and label (0 or 1); ids with both, and nulls, are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    one = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    return one.where(F.col("label") == F.col("_most")).drop("_most")


def label_pairs(rows: DataFrame, most: int) -> DataFrame:
    """better, worse (features): pairs of rows with label 1 and with label 0, in which every row occurs.

    ``rows``: doc_id (unique), label, x. Both labels are numbered in an order by hash, and in each
    round every row of the commoner one meets the next row of the rarer one, round about; rounds make
    up to ``most`` pairs, and one is made in any case. So pairs grow with the rows.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    dealt = {k: dense_key(rows.where(F.col("label") == k).select("doc_id", "x"), order, "_i") for k in (0, 1)}
    sizes = {k: df.count() for k, df in dealt.items()}
    if not min(sizes.values()):
        return rows.limit(0).select(F.col("x").alias("better"), F.col("x").alias("worse"))
    rare = min(sizes, key=sizes.get)
    rounds = max(1, min(most // max(sizes.values()), sizes[rare]))  # beyond that pairs would come again
    again = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("_round")
    many = dealt[1 - rare].select("x", "_i", again)
    many = many.select(F.col("x").alias("_x"), F.pmod(F.col("_i") + F.col("_round"), F.lit(sizes[rare])).alias("_at"))
    few = dealt[rare].select(F.pmod("_i", F.lit(sizes[rare])).alias("_at"), "x")
    good, bad = ("_x", "x") if rare == 0 else ("x", "_x")
    return many.join(few, "_at").select(F.col(good).alias("better"), F.col(bad).alias("worse"))


def _bend(diff: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What pairs add to the slope (first row) and curvature (the other rows) of the logistic loss at ``w``."""
    p = 1 / (1 + np.exp(np.clip(diff @ w, -700, 700)))  # chance of the opposite
    return np.vstack([diff.T @ p, (diff * (p * (1 - p))[:, None]).T @ diff])


def _newton(added: Callable[[np.ndarray], np.ndarray], squares: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """Newton steps by the sums that ``added`` gives at weights; ``squares``: mean squares of the differences.

    Differences count as scaled by their root mean square, which the weights returned undo.
    """
    scale = np.sqrt(squares)
    scale[scale < 1e-9] = np.inf  # a feature that never differs has no weight
    w = np.zeros(len(scale))
    for _ in range(steps):
        sums = added(w / scale)
        slope = sums[0] / scale - ridge * w
        bend = sums[1:] / np.outer(scale, scale) + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w / scale


def fit(better: np.ndarray, worse: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights that make the pairs likely: Newton steps on the logistic loss of differences."""
    diff = better - worse
    return _newton(lambda w: _bend(diff, w), (diff**2).mean(axis=0), ridge, steps)


def _array(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(batch.num_rows, -1)


def _summed(df: DataFrame, sums: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of what ``sums`` makes of each Arrow batch; a task sends one array to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = sums(batch)
                total = found if total is None else total + found
        if total is not None:
            flat = pa.array([total.ravel().tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([flat, pa.array([total.shape[0]])], names=["sums", "n"])

    parts = sorted((r.sums, r.n) for r in df.mapInArrow(run, "sums array<double>, n long").collect())
    return np.sum([np.array(flat).reshape(n, -1) for flat, n in parts], axis=0)


def fit_pairs(pairs: DataFrame, n: int, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """As ``fit`` over ``n`` written pairs (better, worse): a pass over them for each step."""

    def differences(batch: pa.RecordBatch) -> np.ndarray:
        return _array(batch, "better") - _array(batch, "worse")

    squares = _summed(pairs, lambda b: (differences(b) ** 2).sum(axis=0)[None]).ravel() / n
    return _newton(lambda w: _summed(pairs, lambda b: _bend(differences(b), w)), squares, ridge, steps)


def quantile_cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The quantile of the scores with the least weight on the wrong side, in the middle
    between the two scores next to it; the lowest one of equals."""
    order = np.argsort(scores, kind="stable")
    scores, labels, weights = scores[order], labels[order], weights[order]
    lost = np.concatenate([[0.0], np.cumsum(weights * (labels == 1))])  # good ones below the cut
    kept = np.concatenate([[0.0], np.cumsum((weights * (labels == 0))[::-1])])[::-1]  # bad ones above
    wrong = lost + kept
    wrong[1:-1][scores[1:] == scores[:-1]] = np.inf  # no cut between equal scores
    k = int(np.argmin(wrong))
    if k == 0:
        return float(scores[0] - 1)
    return float((scores[k - 1] + scores[k]) / 2 if k < len(scores) else scores[-1] + 1)


def quantile_cut_of(scored: DataFrame, weights: Sequence[float]) -> float:
    """As ``quantile_cut`` for ``scored`` (score, label), rows of label k weighing ``weights[k]``.

    Scores are range partitioned and sorted. A task goes along its own and returns their weight by
    label and its best cut, seen from where it begins; the driver adds what lies before.
    """
    by_score = scored.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    bad, good = weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = at = before = None
        best, goods, bads = np.inf, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            scores, g, b = (batch.column(c).to_numpy() for c in ("score", "good", "bad"))
            below = good * (goods + np.cumsum(g) - g) - bad * (bads + np.cumsum(b) - b)
            k = int(np.argmin(below))
            if below[k] < best:
                best, at, before = float(below[k]), float(scores[k]), float(scores[k - 1]) if k else last
            first = float(scores[0]) if first is None else first
            last, goods, bads = float(scores[-1]), goods + int(g.sum()), bads + int(b.sum())
        if first is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(_CUTS.names, (first, last, at, before, best, goods, bads)))], _CUTS)

    ordered = by_score.repartitionByRange("score").sortWithinPartitions("score")
    parts = sorted(ordered.mapInArrow(run, "first double, last double, at double, before double, best double, good long, bad long").collect())
    left = sum(p.bad for p in parts)
    passed, end, wrong, cut = 0, None, np.inf, 0.0
    for p in parts:
        here = good * passed + bad * left + p.best
        if here < wrong:
            below = p.before if p.before is not None else end
            wrong, cut = here, p.at - 1 if below is None else (below + p.at) / 2
        passed, left, end = passed + p.good, left - p.bad, p.last
    return float(end + 1 if good * passed < wrong else cut)


_CUTS = pa.schema([*((c, pa.float64()) for c in ("first", "last", "at", "before", "best")), ("good", pa.int64()), ("bad", pa.int64())])


def learn(docs: DataFrame, labels: DataFrame, pairs: int = 40_000) -> Ranker:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, label; 1 better than 0).

    Every labelled id teaches: in ``pairs`` pairs, or as many as the commoner label has ids if that is
    more, and in the cut. Only sums over the features, some 30 numbers each, reach the driver.
    """
    taught = with_features(docs).join(known_labels(labels), "doc_id")  # texts are not shuffled, features are
    rows = materialise(taught.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")), "ranking-features")
    met = materialise(label_pairs(rows, pairs), "ranking-pairs")
    n = met.count()
    if not n:
        return NOTHING
    weights = fit_pairs(met, n)
    sizes = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    taken = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}

    def answer(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(_array(batch, "x") @ weights), batch.column("label")], names=["score", "label"])

    scored = per_batch(rows.select("x", "label"), answer, T.StructType([T.StructField("score", T.DoubleType()), rows.schema["label"]]))
    return Ranker(tuple(weights.tolist()), quantile_cut_of(scored, [sizes.get(k, 0) / max(1, taken.get(k, 0)) for k in (0, 1)]))


def rank(docs: DataFrame, ranker: Ranker, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys`` of every row of ``docs`` with its score, 0 to 1; one pass, no shuffle."""
    schema = docs.select(*keys).schema.add("score", "double")

    def answer(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = ranker.score(np.array([features(t) for t in texts(batch)]))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(scores)], names=[*keys, "score"])

    return per_batch(docs.select(*keys, "text"), answer, schema)


def keep_ranked(docs: DataFrame, ranker: Ranker, least: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score ``least`` or more."""

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(ranker.score(np.array([features(t) for t in texts(batch)])) >= least))

    return per_batch(docs, keep, docs.schema)


def held_out() -> Column:
    """crc32 of the id's text is 0 modulo 5; a null id is not held out, nor does it teach."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` scored by what the labels (doc_id, quality) outside the held-out part teach."""
    taught = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    scored = rank(docs, learn(docs, taught))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
