"""Near copies by improved consistent weighted sampling of TF-IDF word shingles.

A shingle weighs its count in the document times 1 plus its relative rarity (0 to 1), from
counts of documents over all documents. Counts are kept in 2**20 hashed cells: a cell's
count also holds the other shingles that share it, so rarity ends where a shingle is in
fewer documents than such a cell has by chance, a fixed share of the corpus at any size.

Each of 56 samplers draws one shingle and a quantised weight of a document, the same one
for two documents with a probability of their weighted Jaccard similarity. Fourteen bands of
four draws give buckets (at a similarity of 0.8 they miss one pair in 1,600). Documents with the same
words are one class, named by its smallest id. Links between classes are looked for in two rounds, so that a bucket of one
large group is not expanded into pairs:

1. every class of a bucket against the bucket's smallest class;
2. classes of a bucket that are still in different components against each other, in
   blocks of a bounded size. A block returns the links that join components, not pairs.

What two classes in one component have in common needs no further check: the result
is components. A pair that meets in several buckets is looked at in the first of them.
Pairs whose total weights or draws rule the similarity out are dropped
(the draws with a chance of a miss far below that of the bands); all others are verified by
their exact weighted Jaccard similarity, from their whole texts.

Cases: null and empty texts and texts without words link with nothing. Rows that share an
id are one document: that of the row with the least hash among those whose texts have words. Rows with a null id link with nothing and are kept. Ties cannot arise:
a similarity of exactly 0.8 links. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import text_slices, texts
from tallymill.llm.graph import components
from tallymill.llm.shingles import digest, mix, shingles, word_hashes
from tallymill.session import materialise

SIMILARITY = 0.8
BANDS, ROWS = 14, 4
SAMPLERS = BANDS * ROWS
CELL_BITS = 20
#: A shingle found nowhere else weighs more than one found everywhere by this share.
RARITY_WEIGHT = 1.0
#: A block of the second round holds about so many classes or characters at most.
BLOCK_CLASSES, BLOCK_CHARS = 128, 1 << 23
#: Cells travel in slices of this many.
SLICE = 1 << 13
#: Of 56 draws so many at least agree if the similarity is 0.8, but for one pair in twenty thousand.
LEAST_DRAWS = 32
#: Shingles that a task of the verification remembers, so that a text met again is not read again.
REMEMBERED = 1 << 21
_POOL_BITS = 16
#: Shingles drawn from in one go, so that the arrays stay in the processor's cache.
_BLOCK = 1 << 13


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """Relative rarity (0 to 1) by cell, counted over all documents.

    Tasks count their own documents and send fixed slices; the driver gets 2**20 numbers.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(1 << CELL_BITS, np.int64), 0
        for batch in batches:
            for words in (words for part in text_slices(batch) for words in word_hashes(part)):
                if len(words):
                    n += 1
                    np.add.at(counts, np.unique(_cells(shingles(words))), 1)
        parts = [counts[i : i + SLICE].astype(np.uint32).tobytes() for i in range(0, len(counts), SLICE)] if n else []
        columns = [pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["slice", "n", "counts"])

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for part in table.column("counts"):
            total += np.frombuffer(part.as_buffer(), np.uint32)
        n = sum(table.column("n").to_pylist())
        return pa.table({"slice": table.column("slice")[:1], "n": [n], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "slice int, n long, counts binary"
    rows = docs.select("text").mapInArrow(counted, schema).groupBy("slice").applyInArrow(added, schema).collect()
    if not rows:
        return np.ones(1 << CELL_BITS, np.float32)
    n = rows[0]["n"]
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in sorted(rows, key=lambda r: r["slice"])])
    least = max(1.0, counts.mean())  # what a cell has by chance
    span = math.log(max(n / least, math.e))
    return np.clip(np.log(n / np.maximum(counts, least)) / span, 0, 1).astype(np.float32)


@cache
def _samplers() -> tuple[np.ndarray, ...]:
    """Fixed multipliers of each sampler, and a pool of step widths and offsets that hashes pick from."""
    draw = np.random.default_rng(20_10)
    odd = draw.integers(0, 1 << 63, (3, SAMPLERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    size = 1 << _POOL_BITS
    step = draw.gamma(2.0, size=size).astype(np.float32)
    offset = draw.random(size).astype(np.float32)
    return odd, step, offset


def weighted(words: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and their weights."""
    found, counts = np.unique(shingles(words), return_counts=True)
    return found, (counts * (1.0 + RARITY_WEIGHT * rare[_cells(found)])).astype(np.float32)


def draws(found: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each document (a run of shingles from one start to the next) and sampler the least hash value.

    The value is a function of the drawn shingle and its quantised weight alone, so equal
    values mean equal draws.
    """
    odd, step, offset = _samplers()
    log_weight = np.log(weights)
    out = np.empty((SAMPLERS, len(starts)), np.float32)
    value = np.empty(len(found), np.float32)
    shift, half, scale = np.uint64(64 - _POOL_BITS), np.uint64(40), np.float32(2.0**-24)
    for k in range(SAMPLERS):
        for at in range(0, len(found), _BLOCK):
            part = slice(at, at + _BLOCK)
            h = found[part]
            pick = ((h * odd[0, k]) >> shift).astype(np.int32)
            r, b = step[pick], offset[pick]
            u = (((h * odd[1, k]) >> half).astype(np.float32) + np.float32(0.5)) * scale
            v = (((h * odd[2, k]) >> half).astype(np.float32) + np.float32(0.5)) * scale
            level = np.floor(log_weight[part] / r + b)
            value[part] = np.log(-np.log(u * v)) - r * (level - b + np.float32(1))
        np.minimum.reduceat(value, starts, out=out[k])
    return out.T


def _bands(drawn: np.ndarray) -> np.ndarray:
    """A 64-bit key for each document and band."""
    bits = drawn.view(np.uint32).astype(np.uint64).reshape(len(drawn), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(drawn), BANDS)).copy()
    for i in range(ROWS):
        key = mix(key ^ bits[:, :, i]) + np.uint64(i + 1)
    return key.view(np.int64)


def signatures(docs: DataFrame, shared) -> DataFrame:
    """doc_id, words (digest), weight, bands, draws and text_key (hash) of each row with words."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = shared.value
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            group: list[tuple] = []
            size = 0
            every = (words for part in text_slices(batch) for words in word_hashes(part))
            for doc_id, key, words in zip(ids, keys, every):
                if len(words):
                    group.append((doc_id, digest(words), *weighted(words, rare), key))
                    size += len(group[-1][2])
                if size > 1 << 18:
                    yield packed(group)
                    group, size = [], 0
            if group:
                yield packed(group)

    def packed(group: list[tuple]) -> pa.RecordBatch:
        sizes = [len(g[2]) for g in group]
        drawn = np.ascontiguousarray(draws(np.concatenate([g[2] for g in group]), np.concatenate([g[3] for g in group]), np.cumsum([0, *sizes[:-1]])))
        bands = _bands(drawn)
        columns = [
            pa.array([g[0] for g in group], pa.int64()),
            pa.array([g[1] for g in group], pa.binary()),
            pa.array([float(g[3].sum(dtype=np.float64)) for g in group], pa.float64()),
            pa.array(list(bands), pa.list_(pa.int64())),
            pa.array([d.tobytes() for d in drawn], pa.binary()),
            pa.array([g[4] for g in group], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "words", "weight", "bands", "drawn", "text_key"])

    schema = "doc_id long, words binary, weight double, bands array<long>, drawn binary, text_key long"
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return known.mapInArrow(signed, schema)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: common weight over joint weight."""
    few, many = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    at = np.minimum(np.searchsorted(many[0], few[0]), len(many[0]) - 1)
    same = many[0][at] == few[0]
    common = float(np.minimum(few[1][same], many[1][at[same]]).sum(dtype=np.float64))
    return common / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - common)


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) those whose draws leave the similarity possible."""

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, SAMPLERS) for c in ("x", "y"))
            near = pa.array((x == y).sum(axis=1) >= LEAST_DRAWS)
            yield batch.select(["a", "b"]).filter(near)

    first = classes.select(F.col("class_id").alias("a"), F.col("drawn").alias("x"))
    second = classes.select(F.col("class_id").alias("b"), F.col("drawn").alias("y"))
    return pairs.join(second, "b").join(first, "a").select("a", "b", "x", "y").mapInArrow(enough, "a long, b long")


def _verified(pairs: DataFrame, candidates: DataFrame, shared) -> DataFrame:
    """``pairs`` (a, b) that are similar enough, by their texts in ``candidates`` (class_id, text).

    The texts of b, mostly distinct, move with the pairs; that of an often met a is only read beside them.
    """

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, known, size = shared.value, {}, 0
        for batch in batches:
            if size > REMEMBERED:
                known, size = {}, 0
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            new: dict[int, str] = {}
            for ids, column in ((a, batch.column("x")), (b, batch.column("y"))):
                for row, i in enumerate(ids):
                    if i not in known and i not in new:
                        new[i] = column[row].as_py()
            for i, words in zip(new, word_hashes(list(new.values()))):
                known[i] = weighted(words, rare)
                size += len(known[i][0])
            keep = [similarity(known[i], known[j]) >= SIMILARITY for i, j in zip(a, b)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    second = candidates.select(F.col("class_id").alias("b"), F.col("text").alias("y"))
    first = candidates.select(F.col("class_id").alias("a"), F.col("text").alias("x"))
    return pairs.join(second, "b").join(first, "a").select("a", "b", "x", "y").mapInArrow(similar, "a long, b long")


def _joining(open_rows: DataFrame, shared) -> DataFrame:
    """Links a, b between classes of one bucket and different components, at least enough to join what is linked.

    ``open_rows``: band, class_id, component, weight, text, bands, drawn.
    """
    sizes = open_rows.groupBy("band").agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars"))
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_CLASSES, F.col("chars") / BLOCK_CHARS))
    placed = open_rows.join(sizes.select("band", parts.alias("parts")), "band")
    part = F.pmod(F.xxhash64("class_id"), F.col("parts")).alias("part")
    row = F.struct("class_id", "component", "weight", "bands", "drawn", "text")
    blocks = placed.groupBy("band", "parts", part).agg(F.collect_list(row).alias("rows"))
    blocks = materialise(blocks, "near-blocks")
    left = blocks.select("band", F.col("part"), F.col("rows").alias("x"), F.explode(F.sequence(F.col("part"), F.col("parts") - 1)).alias("other"))
    right = blocks.select("band", F.col("part").alias("other"), F.col("rows").alias("y"))
    met = left.join(right, ["band", "other"]).select("band", "part", "other", "x", "y")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, known = shared.value, {}
        for batch in batches:
            links: list[tuple[int, int]] = []
            for i in range(batch.num_rows):
                band, part, other = (batch.column(c)[i].as_py() for c in ("band", "part", "other"))
                x = batch.column("x")[i].as_py()
                y = x if part == other else batch.column("y")[i].as_py()
                links += _links_of_blocks(band, x, y, part == other, rare, known)
                if sum(len(w[0]) for w in known.values()) > REMEMBERED:
                    known.clear()
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return met.mapInArrow(joined, "a long, b long")


def _links_of_blocks(band: int, x: list[dict], y: list[dict], same: bool, rare: np.ndarray, known: dict) -> list[tuple[int, int]]:
    draws_x, draws_y = (np.frombuffer(b"".join(r["drawn"] for r in rows), np.uint32).reshape(-1, SAMPLERS) for rows in (x, y))
    bands_x, bands_y = (np.array([r["bands"] for r in rows]) for rows in (x, y))
    weight_x, weight_y = (np.array([r["weight"] for r in rows]) for rows in (x, y))
    agree = (draws_x[:, None] == draws_y[None]).sum(axis=2)
    shared_bands = bands_x[:, None] == bands_y[None]
    first = np.take_along_axis(np.broadcast_to(bands_x[:, None], shared_bands.shape), shared_bands.argmax(axis=2)[:, :, None], 2)[:, :, 0]
    close = np.minimum(weight_x[:, None], weight_y[None]) >= SIMILARITY * (1 - 1e-5) * np.maximum(weight_x[:, None], weight_y[None])
    wanted = (agree >= LEAST_DRAWS) & (first == band) & close
    if same:
        wanted &= np.triu(np.ones_like(wanted), 1)
    i, j = np.nonzero(wanted)
    order = np.argsort(-agree[i, j], kind="stable")  # likely links first: what they join needs no further look
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            c = up
        return c

    def shingled(row: dict) -> tuple[np.ndarray, np.ndarray]:
        if row["class_id"] not in known:
            known[row["class_id"]] = weighted(next(word_hashes([row["text"]])), rare)
        return known[row["class_id"]]

    links = []
    for k in order.tolist():
        a, b = x[i[k]], y[j[k]]
        one, two = root(a["component"]), root(b["component"])
        if one != two and similarity(shingled(a), shingled(b)) >= SIMILARITY:
            parent[max(one, two)] = min(one, two)
            links.append((a["class_id"], b["class_id"]))
    return links


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest id with the same words), component_id (smallest id linked to) and kept, for each id."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(rarity(docs))
    # rows that share an id count once, by the least hash of their texts
    one = F.min(F.struct("text_key", "words", "weight", "bands", "drawn")).alias("one")
    signed = materialise(signatures(docs, shared).groupBy("doc_id").agg(one).select("doc_id", "one.*"), "near-signatures")
    own = signed.select("doc_id", "words")
    classes = signed.groupBy("words").agg(
        F.min(F.struct("doc_id", "text_key")).alias("named"), F.first("weight").alias("weight"), F.first("bands").alias("bands"), F.first("drawn").alias("drawn")
    )
    classes = classes.select("words", F.col("named.doc_id").alias("class_id"), F.col("named.text_key").alias("text_key"), "weight", "bands", "drawn")
    classes = materialise(classes, "near-classes")
    placed = classes.select("class_id", "weight", F.explode("bands").alias("band"))
    heads = placed.groupBy("band").agg(F.min(F.struct("class_id", "weight")).alias("head"), F.count("*").alias("n")).where("n > 1")
    members = materialise(placed.join(heads.select("band", "head"), "band"), "near-buckets")
    by_weight = F.least("weight", "head.weight") >= SIMILARITY * (1 - 1e-5) * F.greatest("weight", "head.weight")
    stars = members.where((F.col("class_id") != F.col("head.class_id")) & by_weight)
    stars = stars.select(F.col("head.class_id").alias("a"), F.col("class_id").alias("b")).distinct()
    stars = materialise(_plausible(stars, classes), "near-pairs")

    wanted = classes.select("class_id", "text_key", "bands", "drawn").join(members.select("class_id").distinct(), "class_id", "left_semi")
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("class_id"), F.xxhash64("text").alias("text_key"), "text")
    # the same plan at every size: texts move once, the ids wanted are never sent to all tasks
    met = rows.join(wanted.hint("merge"), ["class_id", "text_key"])
    candidates = met.groupBy("class_id").agg(*[F.first(c).alias(c) for c in ("text", "bands", "drawn")])  # equal rows once
    candidates = materialise(candidates, "near-texts")
    links = materialise(_verified(stars, candidates, shared), "near-links")
    joined = components(links)

    labels = joined.select(F.col("node").alias("class_id"), "component")
    others = members.where(F.col("class_id") != F.col("head.class_id"))  # the first round compared the heads with all
    labelled = others.select("band", "class_id", "weight").join(labels, "class_id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "class_id"))
    mixed = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    open_rows = labelled.join(mixed.select("band"), "band", "left_semi").join(candidates, "class_id")
    more = materialise(_joining(open_rows, shared), "near-links")
    if not more.isEmpty():
        joined = components(links.unionByName(more))

    found = own.join(classes.select("words", "class_id"), "words")
    found = found.join(joined.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    found = found.select("doc_id", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    wordless = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().join(found, "doc_id", "left_anti")
    every = found.unionByName(wordless.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id")))
    return every.withColumn("kept", F.col("doc_id") == F.col("component_id"))


#: The characters of words, as in ``shingles``.
_WORD = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]"


def keep_first(docs: DataFrame) -> DataFrame:
    """Of ``docs``, all columns, one row of the document with the smallest id of each group; null ids stay.

    Of rows that share an id the one that stands for the document is kept.
    """
    dropped = materialise(near_groups(docs).where(~F.col("kept")).select("doc_id"), "near-dropped")
    named = docs.where(F.col("doc_id").isNotNull()).join(dropped, "doc_id", "left_anti").select(*docs.columns)
    wordless = ~F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    order = F.struct(wordless, F.xxhash64("text"), F.xxhash64(*docs.columns))
    one = named.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("row"))
    return one.select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))
