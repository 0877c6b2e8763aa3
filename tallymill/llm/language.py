"""Language identification: known words first, ever shorter character n-grams for the rest.

A known word scores its log frequency in each language. An unseen word is padded with
``_`` and falls back to its n-grams: the longest length of which any is known scores,
by their mean log frequency. A text takes the language with the highest sum over its words.
Known is what a language's texts have at least ``MIN_COUNT`` times, whatever the other languages
have; so the size of a profile follows from the vocabulary, of which all texts count.

Cases: a null text or one without a letter is ``und`` with score 0; so is every text if
nothing was learned. Ties go to the alphabetically first language. Texts of any length are
read whole. Repeated rows are each answered; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import per_task, text_slices
from tallymill.session import materialise

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: Lengths of n-grams, in the order in which an unseen word falls back.
LENGTHS = (5, 4, 3, 2, 1)
#: Times that a language's texts must have a word or n-gram for it to be known there.
MIN_COUNT = 2
#: Evidence counts as that of so many words at most when it is turned into a score.
SCORE_WORDS = 16
#: Bytes that a task spends on remembered pieces, whatever the number of languages, and the longest piece remembered.
REMEMBERED_BYTES, REMEMBERED_LENGTH = 24 << 20, 40
#: The seed with which Spark's xxhash64 begins.
_SEED = 42


def _key(text: str) -> int:
    """Spark's xxhash64 of a text, as an unsigned number."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), _SEED)


@dataclass(frozen=True)
class Table:
    """Log frequencies of words, or of n-grams of one length.

    ``keys`` are hashes, ascending; entries ``begins[i]`` to ``begins[i + 1]`` belong to the i-th.
    An entry holds a language and by how much its log frequency exceeds that of the unseen (``floor``).
    """

    keys: np.ndarray
    begins: np.ndarray
    langs: np.ndarray
    gains: np.ndarray
    floor: np.ndarray

    def find(self, hashes: Sequence[int]) -> np.ndarray:
        """Place of each hash, or -1."""
        wanted = np.array(hashes, dtype=np.uint64)
        if not len(self.keys):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)

    def rows(self, places: np.ndarray) -> np.ndarray:
        """Log frequencies in every language, a row for each place."""
        out = np.tile(self.floor, (len(places), 1))
        sizes = self.begins[places + 1] - self.begins[places]
        row = np.repeat(np.arange(len(places)), sizes)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.begins[places], sizes)
        out[row, self.langs[entry]] += self.gains[entry]
        return out


@dataclass(frozen=True)
class Profile:
    langs: tuple[str, ...]
    words: Table
    grams: tuple[Table, ...]  # by LENGTHS


def _table(counts: pa.Table, n_langs: int) -> Table:
    """From rows of key, lang (a number) and n."""
    keys = counts.column("key").to_numpy().view(np.uint64)
    langs, n = counts.column("lang").to_numpy().astype(np.int32), counts.column("n").to_numpy().astype(float)
    order = np.lexsort((langs, keys))
    keys, langs, n = keys[order], langs[order], n[order]
    found, first = np.unique(keys, return_index=True)
    totals = np.bincount(langs, weights=n, minlength=n_langs) + 0.5 * max(len(found), 1)
    gains = np.log(n + 0.5) - np.log(0.5)
    return Table(found, np.append(first, len(keys)), langs, gains.astype(np.float32), np.log(0.5 / totals))


def learn(labelled: DataFrame) -> Profile:
    """Fit the frequencies on all of ``labelled`` (text, lang), rows without text or lang apart.

    Of the words and n-grams that are known the driver gets hashes and counts.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    langs = tuple(sorted(r["lang"] for r in rows.select("lang").distinct().collect()))
    numbers = F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))]) if langs else None
    if numbers is None:
        nothing = _table(pa.table({"key": pa.array([], pa.int64()), "lang": pa.array([], pa.int32()), "n": pa.array([], pa.int64())}), 0)
        return Profile((), nothing, (nothing,) * len(LENGTHS))
    words = (
        rows.select(numbers[F.col("lang")].alias("lang"), F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("item"))
        .where(F.col("item") != "")
        .groupBy("lang", "item")
        .agg(F.count("*").alias("n"))
    )
    words = materialise(words, "language-words")
    padded = F.concat(F.lit("_"), F.col("item"), F.lit("_"))

    def pieces(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length("item") + 3 - n, F.lit(1)))
        named = F.transform(starts, lambda at: F.struct(F.lit(n).alias("length"), F.xxhash64(F.substring(padded, at, F.lit(n))).alias("key")))
        return F.when(F.length("item") + 2 >= n, named).otherwise(F.array().cast("array<struct<length:int,key:bigint>>"))

    grams = words.select("lang", "n", F.explode(F.concat(*[pieces(n) for n in LENGTHS])).alias("of"))
    grams = grams.groupBy("lang", "of.length", "of.key").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    known = words.where(F.col("n") >= MIN_COUNT).select("lang", F.lit(0).alias("length"), F.xxhash64("item").alias("key"), "n")
    counts = known.unionByName(grams).toArrow()
    length = counts.column("length").to_numpy()
    tables = [_table(counts.filter(pa.array(length == n)), len(langs)) for n in (0, *LENGTHS)]
    return Profile(langs, tables[0], tuple(tables[1:]))


class Scorer:
    """Scores texts against a profile; remembers pieces it has met, within ``REMEMBERED_BYTES``."""

    def __init__(self, profile: Profile):
        self.profile, self.width = profile, len(profile.langs)
        # a row of numbers, and about 200 bytes for the piece and its place
        self.most = max(64, REMEMBERED_BYTES // (8 * (self.width + 1) + 200))
        self.place: dict[str, int] = {}
        self.rows = np.zeros((min(self.most, 4096), self.width + 1))  # the last column counts words

    def words(self, words: Sequence[str]) -> np.ndarray:
        """Log frequencies of words, a row for each: their own, or their n-grams' mean."""
        out = np.zeros((len(words), self.width))
        at = self.profile.words.find([_key(w) for w in words])
        known = np.flatnonzero(at >= 0)
        out[known] = self.profile.words.rows(at[known])
        left = np.flatnonzero(at < 0).tolist()
        for n, table in zip(LENGTHS, self.profile.grams):
            if not left:
                break
            padded = [f"_{words[i]}_" for i in left]
            sizes = np.array([max(0, len(p) - n + 1) for p in padded])
            found = table.find([_key(p[k : k + n]) for p, size in zip(padded, sizes.tolist()) for k in range(size)])
            owner = np.repeat(np.arange(len(left)), sizes)[found >= 0]
            hits = np.bincount(owner, minlength=len(left))
            sums = np.zeros((len(left), self.width))
            np.add.at(sums, owner, table.rows(found[found >= 0]))
            met = np.flatnonzero(hits)
            out[np.array(left)[met]] = sums[met] / hits[met, None]
            left = [i for i, n_hits in zip(left, hits.tolist()) if not n_hits]
        return out

    def pieces(self, pieces: Sequence[str]) -> np.ndarray:
        """Sums over the words of space-delimited pieces, and their number, a row for each."""
        # not superscripts and the like alone
        split = [[w for w in WORD.findall(p.lower()) if any(map(str.isalpha, w))] for p in pieces]
        distinct = {w: i for i, w in enumerate(dict.fromkeys(w for words in split for w in words))}
        values = self.words(list(distinct))
        out = np.zeros((len(pieces), self.width + 1))
        owner = np.repeat(np.arange(len(pieces)), [len(words) for words in split])
        np.add.at(out[:, :-1], owner, values[[distinct[w] for words in split for w in words]])
        out[:, -1] = [len(words) for words in split]
        return out

    def _remember(self, unseen: list[str]) -> None:
        need = len(self.place) + len(unseen)
        if need > len(self.rows):
            grown = np.zeros((min(self.most, max(need, 2 * len(self.rows))), self.width + 1))
            grown[: len(self.place)] = self.rows[: len(self.place)]
            self.rows = grown
        self.rows[len(self.place) : need] = self.pieces(unseen)
        self.place.update(zip(unseen, range(len(self.place), need)))

    def totals(self, texts: Sequence[str]) -> np.ndarray:
        """Sums over the words of each text, and their number."""
        out = np.zeros((len(texts), self.width + 1))
        split = [t.split() for t in texts]
        for begin in range(0, len(texts), 64):
            part = split[begin : begin + 64]
            unseen = {p for pieces in part for p in pieces}.difference(self.place)
            long = [p for p in unseen if len(p) > REMEMBERED_LENGTH]
            short = sorted(unseen.difference(long))
            if len(self.place) + len(short) > self.most:
                self.place.clear()
                short = sorted({p for pieces in part for p in pieces if len(p) <= REMEMBERED_LENGTH})
            if len(short) > self.most:  # more than may be remembered at all: piece by piece, not kept
                for i, pieces in enumerate(part, begin):
                    for at in range(0, len(pieces), self.most):
                        out[i] += self.pieces(pieces[at : at + self.most]).sum(axis=0)
                continue
            if short:
                self._remember(short)
            apart = dict(zip(long, self.pieces(long))) if long else {}
            for i, pieces in enumerate(part, begin):
                known = [p for p in pieces if p not in apart] if apart else pieces
                out[i] = self.rows[np.fromiter(map(self.place.__getitem__, known), np.int64, len(known))].sum(axis=0)
                for p in pieces if apart else ():
                    if p in apart:
                        out[i] += apart[p]
        return out

    def predict(self, texts: Sequence[str]) -> list[tuple[str, float]]:
        found = []
        for total in self.totals(texts):
            words = total[-1]
            if not words or not self.width:
                found.append((UNDETERMINED, 0.0))
                continue
            sums = total[:-1] * min(1.0, SCORE_WORDS / words)
            best = int(np.argmax(sums))
            found.append((self.profile.langs[best], float(1.0 / np.exp(sums - sums[best]).sum())))
        return found


def _answers(scorer: Scorer, batch: pa.RecordBatch) -> list[tuple[str, float]]:
    return [x for texts in text_slices(batch) for x in scorer.predict(texts)]


def identify(docs: DataFrame, profile: Profile, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys`` of every row of ``docs`` with lang_pred and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(profile)
    schema = docs.select(*keys).schema.add("lang_pred", "string").add("score", "double")

    def begin() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        scorer = Scorer(shared.value)  # what it remembers goes with the task

        def answer(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _answers(scorer, batch)
            columns = [batch.column(k) for k in keys]
            columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, "lang_pred", "score"])

        return answer

    return per_task(docs.select(*keys, "text"), begin, schema)


def keep_identified(docs: DataFrame, profile: Profile, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is found with at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(profile)

    def begin() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        scorer = Scorer(shared.value)

        def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in _answers(scorer, batch)]))

        return keep

    return per_task(docs, begin, docs.schema)


def training_part(docs: DataFrame) -> DataFrame:
    """The documents that may teach: crc32 of the id's text is not 1 modulo 3."""
    return docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1).select("doc_id", "text", "lang")
