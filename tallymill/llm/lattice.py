"""Near copies of embeddings by lattice hashing.

Unit vectors are projected at random, eight coordinates at a time, and decoded to the
nearest point of the E8 lattice. A table's cell is a pair of such points; there are
several tables. A vector lies in its home cell and also visits neighbouring cells: those
of the next nearest lattice points in either block. Two vectors are candidates if one
visits the home of the other in some table, and are verified by cosine in double precision.

Groups of copies are not expanded into pairs. First vectors gather, over three coarser
tables, around leaders within half the link angle; by the triangle inequality all of such
a clique link with each other. Candidates are then pairs of cliques, one row a cell and
clique. Most pairs are settled by the angle between leaders and the radii of the cliques:
no link at all, or all with all. The rest are compared member by member in blocks of
matrix products which give counts, not pairs.

A crowded cell, whose cliques would make many pairs, makes none of its small cliques. Their
members are cut into chunks, and each two chunks are one matrix product, which gives the
number of links of a vector and the few links that join what the block connects. Cliques
that meet in several crowded cells count in the first of them, and not outside. Large
cliques, of which a cell has fewer, meet others as before.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing. Rows that share an id are one vector, the smallest; a null id is returned as a
row of its own without links. Vectors of different lengths never link. A cosine of exactly
the threshold links. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.graph import components
from tallymill.llm.shingles import mix
from tallymill.llm.vectors import by_length, matrix, usable
from tallymill.session import materialise

#: At a cosine of 0.95 a table finds about half of the pairs; 24 miss one in some millions.
TABLES, BLOCKS, NEIGHBOURS = 24, 2, 2
SCALE, COARSE_SCALE, COARSE_TABLES = 0.6, 0.5, 3
#: Vectors compared at once in a block.
CHUNK = 512
#: A cell that would make more pairs of cliques is crowded.
CELL_PAIRS = 4_096
#: Cliques of more members meet others as a whole in crowded cells, too.
SMALL = 32
#: Angles within this of a bound are compared vector by vector.
MARGIN = 1e-6


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: integers with an even sum, or halves with an even sum."""

    def even(y: np.ndarray) -> np.ndarray:
        point = np.rint(y)
        odd = np.flatnonzero(point.sum(axis=1) % 2)
        off = y[odd] - point[odd]
        worst = np.abs(off).argmax(axis=1)
        at = np.arange(len(odd))
        point[odd, worst] += np.where(off[at, worst] >= 0, 1.0, -1.0)
        return point

    whole, half = even(x), even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors of the lattice, the steps to a point's neighbours."""
    steps = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            step = np.zeros(8)
            step[i], step[j] = a, b
            steps.append(step)
    steps += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(steps)


@cache
def _projections(dimension: int, tables: int, blocks: int, scale: float, seed: int) -> np.ndarray:
    draw = np.random.default_rng([seed, dimension])
    return draw.normal(size=(tables, blocks, dimension, 8)) * scale


@cache
def _odd(blocks: int) -> np.ndarray:
    return np.random.default_rng(8).integers(0, 1 << 62, (blocks, 8), dtype=np.int64) * 2 + 1


def _block_hash(points: np.ndarray, block: int, blocks: int) -> np.ndarray:
    doubled = np.rint(points * 2).astype(np.int64)
    return (doubled * _odd(blocks)[block]).sum(axis=-1, dtype=np.int64).view(np.uint64)


def cells(units: np.ndarray, tables: int, blocks: int, scale: float, neighbours: int, seed: int) -> np.ndarray:
    """Keys of the cells a row is in, by table: its home, then those it visits."""
    steps, out = shortest(), []
    for t, projection in enumerate(_projections(units.shape[1], tables, blocks, scale, seed)):
        options = []
        for b in range(blocks):
            x = units @ projection[b]
            home = decode(x)
            points = [home]
            if neighbours:
                along = (x - home) @ steps.T
                best = np.argpartition(-along, neighbours, axis=1)[:, :neighbours]
                points += [home + steps[best[:, i]] for i in range(neighbours)]
            options.append([_block_hash(p, b, blocks) for p in points])
        keys = [mix(sum(choice) + np.uint64((units.shape[1] << 16) + t + 1)) for choice in itertools.product(*options)]
        out.append(np.stack(keys, axis=1))
    return np.stack(out, axis=1).view(np.int64)


def _units(vectors: DataFrame) -> DataFrame:
    """vec_id, v (unit vector), coarse, home and visited cells."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_length(batch.column("v")):
                part = batch.take(pa.array(rows))
                v = matrix(part.column("v"))
                v = v / np.abs(v).max(axis=1, keepdims=True)  # keeps squares in range
                v = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
                coarse = cells(v, COARSE_TABLES, 1, COARSE_SCALE, 0, 1)[:, :, 0]
                fine = cells(v, TABLES, BLOCKS, SCALE, NEIGHBOURS, 2)
                lists = (coarse, fine[:, :, 0], fine[:, :, 1:].reshape(len(v), -1))
                columns = [part.column("vec_id"), pa.array([x.tobytes() for x in v], pa.binary())]
                columns += [pa.array(list(np.ascontiguousarray(x)), pa.list_(pa.int64())) for x in lists]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "coarse", "home", "visited"])

    return vectors.mapInArrow(hashed, "vec_id long, v binary, coarse array<long>, home array<long>, visited array<long>")


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip((a * b).sum(axis=1), -1.0, 1.0))


def _gathered(units: DataFrame, half: float) -> DataFrame:
    """vec_id, v and leader: vectors with one leader lie within ``half`` of that leader's vector."""
    state = units.select("vec_id", "v", "coarse", F.col("vec_id").alias("leader"), F.col("v").alias("lv"))
    schema = "vec_id long, v binary, coarse array<long>, leader long, lv binary"

    def adopt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_length(batch.column("v")):
                part = batch.take(pa.array(rows))
                near = _angles(matrix(part.column("v")), matrix(part.column("hv"))) <= half - MARGIN
                offered, own = part.column("head").to_numpy(), part.column("leader").to_numpy()
                take = pa.array(near & (offered < own))
                leader = pc.if_else(take, part.column("head"), part.column("leader"))
                lv = pc.if_else(take, part.column("hv"), part.column("lv"))
                columns = [part.column("vec_id"), part.column("v"), part.column("coarse"), leader, lv]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "coarse", "leader", "lv"])

    for t in range(COARSE_TABLES):
        state = state.withColumn("cell", F.col("coarse")[t])
        head = F.min(F.struct("leader", "lv")).alias("h")
        heads = state.groupBy("cell").agg(head).select("cell", F.col("h.leader").alias("head"), F.col("h.lv").alias("hv"))
        state = materialise(state.join(heads, "cell").drop("cell").mapInArrow(adopt, schema), "lattice-leaders")
    return state.select("vec_id", "v", "leader", "lv")


def _radii(gathered: DataFrame) -> DataFrame:
    """leader, its vector lv, hub (smallest member), members and radius of each clique."""

    def angled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_length(batch.column("v")):
                part = batch.take(pa.array(rows))
                angle = _angles(matrix(part.column("v")), matrix(part.column("lv")))
                columns = [part.column("vec_id"), part.column("leader"), part.column("lv"), pa.array(angle)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "leader", "lv", "angle"])

    rows = gathered.mapInArrow(angled, "vec_id long, leader long, lv binary, angle double")
    return rows.groupBy("leader").agg(
        F.min("lv").alias("lv"), F.min("vec_id").alias("hub"), F.count("*").alias("members"), F.max("angle").alias("radius")
    )


def _judged(pairs: DataFrame, cliques: DataFrame, link: float) -> DataFrame:
    """Of pairs of leaders (a, b) those whose cliques may link, with whether all do."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_length(batch.column("va")):
                part = batch.take(pa.array(rows))
                angle = _angles(matrix(part.column("va")), matrix(part.column("vb")))
                reach = part.column("ra").to_numpy() + part.column("rb").to_numpy()
                whole = pa.array(angle + reach <= link - MARGIN)
                columns = [part.column("a"), part.column("b"), whole]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "whole"]).filter(pa.array(angle - reach <= link + MARGIN))

    first = cliques.select(F.col("leader").alias("a"), F.col("lv").alias("va"), F.col("radius").alias("ra"))
    second = cliques.select(F.col("leader").alias("b"), F.col("lv").alias("vb"), F.col("radius").alias("rb"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "va", "vb", "ra", "rb").mapInArrow(judge, "a long, b long, whole boolean")


def _compared(pairs: DataFrame, gathered: DataFrame, cliques: DataFrame, cosine: float) -> DataFrame:
    """Member by member: a, b, vec_id and links (how many of the other clique's members it links with)."""
    wanted = pairs.select(F.col("a").alias("leader")).unionByName(pairs.select(F.col("b").alias("leader"))).distinct()
    sized = gathered.select("vec_id", "v", "leader").join(wanted, "leader").join(cliques.select("leader", "members"), "leader")
    part = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("members") / CHUNK))
    rows = F.sort_array(F.collect_list(F.struct("vec_id", "v")))
    chunks = sized.groupBy("leader", part.alias("part")).agg(rows.alias("rows"))
    chunks = chunks.select("leader", F.col("rows.vec_id").alias("ids"), F.col("rows.v").alias("vs"))
    chunks = materialise(chunks, "lattice-chunks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("a", "b", "ids_a", "vs_a", "ids_b", "vs_b")}
                x, y = (np.frombuffer(b"".join(row[c]), np.float64).reshape(len(row[c]), -1) for c in ("vs_a", "vs_b"))
                linked = x @ y.T >= cosine
                ids = np.concatenate([row["ids_a"], row["ids_b"]])
                counts = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
                some = counts > 0
                n = int(some.sum())
                columns = [[row["a"]] * n, [row["b"]] * n, ids[some], counts[some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "vec_id", "links"])

    first = chunks.select(F.col("leader").alias("a"), F.col("ids").alias("ids_a"), F.col("vs").alias("vs_a"))
    second = chunks.select(F.col("leader").alias("b"), F.col("ids").alias("ids_b"), F.col("vs").alias("vs_b"))
    met = pairs.select("a", "b").join(first, "a").join(second, "b")
    return met.mapInArrow(compare, "a long, b long, vec_id long, links long")


def _seats(units: DataFrame, gathered: DataFrame, cliques: DataFrame) -> DataFrame:
    """cell, leader, home (does a member live there, or do some only visit), members: once for a cell and clique."""
    placed = units.join(gathered.select("vec_id", "leader"), "vec_id")
    homes = placed.select("leader", F.explode("home").alias("cell"), F.lit(True).alias("home"))
    visits = placed.select("leader", F.explode("visited").alias("cell"), F.lit(False).alias("home"))
    once = homes.unionByName(visits).groupBy("cell", "leader").agg(F.max("home").alias("home"))
    return materialise(once.join(cliques.select("leader", "members"), "leader"), "lattice-seats")


def _meetings(homes: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs (a, b) of leaders, one of which is at home in a cell that the other is in."""
    met = homes.select("cell", "leader").join(others.select("cell", F.col("leader").alias("guest")), "cell")
    met = met.where(F.col("leader") != F.col("guest"))
    return met.select(F.least("leader", "guest").alias("a"), F.greatest("leader", "guest").alias("b"))


def _marked(crowd: DataFrame) -> DataFrame:
    """leader, and the crowded cells that it is at home in, and that it visits."""
    cell = F.col("cell")
    return crowd.groupBy("leader").agg(
        F.collect_list(F.when(F.col("home"), cell)).alias("lives"), F.collect_list(F.when(~F.col("home"), cell)).alias("calls")
    )


def _apart(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs that meet in no crowded cell."""
    first = marks.select(F.col("leader").alias("a"), F.col("lives").alias("la"), F.col("calls").alias("ca"))
    second = marks.select(F.col("leader").alias("b"), F.col("lives").alias("lb"), F.col("calls").alias("cb"))
    meet = F.arrays_overlap("la", "lb") | F.arrays_overlap("la", "cb") | F.arrays_overlap("ca", "lb")
    return pairs.join(first, "a", "left").join(second, "b", "left").where(~F.coalesce(meet, F.lit(False))).select("a", "b")


def _side(column: pa.ListArray, i: int) -> dict[str, pa.Array]:
    rows = column[i].values
    return dict(zip((f.name for f in rows.type), rows.flatten()))


def _belongs(lists: pa.ListArray, cells: np.ndarray) -> np.ndarray:
    """Which of the sorted ``cells`` each list names, as zeros and ones."""
    out = np.zeros((len(lists), len(cells)), np.float32)
    row, value = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy()
    at = np.minimum(np.searchsorted(cells, value), len(cells) - 1)
    there = cells[at] == value
    out[row[there], at[there]] = 1
    return out


def _met_before(x: dict[str, pa.Array], y: dict[str, pa.Array], cell: int) -> np.ndarray:
    """Do rows of x and y meet in a crowded cell before ``cell``?"""
    named = [np.concatenate([side[c].flatten().to_numpy() for c in ("lives", "calls")]) for side in (x, y)]
    cells = np.intersect1d(*named)
    cells = cells[cells < cell]
    if not len(cells):
        return np.zeros((len(x["leader"]), len(y["leader"])), bool)
    lives_x, calls_x, lives_y, calls_y = (_belongs(side[c], cells) for side in (x, y) for c in ("lives", "calls"))
    return lives_x @ (lives_y + calls_y).T + calls_x @ lives_y.T > 0


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and the columns of ``linked`` the least row they are connected with."""
    n = len(linked)
    row, column = np.arange(n), np.full(linked.shape[1], n)
    while True:
        column = np.minimum(column, np.where(linked, row[:, None], n).min(axis=0))
        least = np.minimum(row, np.where(linked, column[None, :], n).min(axis=1))
        if (least == row).all():
            return row, column
        row = least


def _crowded(crowd: DataFrame, marks: DataFrame, gathered: DataFrame, cosine: float) -> DataFrame:
    """Links between small cliques that meet in crowded cells.

    Rows are vec_id and links (counts of a block, to be added up), or a and b (leaders of linked cliques).
    """
    load = crowd.groupBy("cell", "home").agg(F.sum("members").alias("load"))
    items = crowd.join(load, ["cell", "home"]).join(gathered.select("vec_id", "v", "leader").join(marks, "leader"), "leader")
    part = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("load") / CHUNK))
    rows = F.collect_list(F.struct("leader", "vec_id", "v", "lives", "calls")).alias("rows")
    chunks = materialise(items.groupBy("cell", "home", part.alias("part")).agg(rows), "lattice-crowd")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = _side(batch.column("x_rows"), i), _side(batch.column("y_rows"), i)
                cell, same = batch.column("cell")[i].as_py(), batch.column("same")[i].as_py()
                linked = np.zeros((len(x["v"]), len(y["v"])), bool)
                for r in by_length(x["v"]):
                    for c in by_length(y["v"]):
                        if len(x["v"][int(r[0])].as_py()) == len(y["v"][int(c[0])].as_py()):
                            linked[np.ix_(r, c)] = matrix(x["v"].take(pa.array(r))) @ matrix(y["v"].take(pa.array(c))).T >= cosine
                lx, ly = (side["leader"].to_numpy() for side in (x, y))
                linked &= lx[:, None] != ly[None, :]
                if same:
                    linked = np.triu(linked, 1)
                if linked.any():
                    linked &= ~_met_before(x, y, cell)
                if not linked.any():
                    continue
                ids = np.concatenate([x["vec_id"].to_numpy(), y["vec_id"].to_numpy()])
                counts = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
                some = counts > 0
                root = np.concatenate(_forest(linked))[some]
                joined = np.unique(np.stack([np.concatenate([lx, ly])[some], lx[root]], axis=1), axis=0)
                joined = joined[joined[:, 0] != joined[:, 1]]
                n, m = int(some.sum()), len(joined)
                none = pa.nulls
                columns = [(ids[some], none(m)), (counts[some], none(m)), (none(n), joined[:, 0]), (none(n), joined[:, 1])]
                merged = [pa.concat_arrays([pa.array(c).cast(pa.int64()) for c in pair]) for pair in columns]
                yield pa.RecordBatch.from_arrays(merged, names=["vec_id", "links", "a", "b"])

    index = chunks.select("cell", "home", "part")
    x = index.where("home").select("cell", F.col("part").alias("x_part"))
    y = index.select("cell", F.col("home").alias("y_home"), F.col("part").alias("y_part"))
    blocks = x.join(y, "cell").where(~F.col("y_home") | (F.col("y_part") >= F.col("x_part")))
    first = chunks.where("home").select("cell", F.col("part").alias("x_part"), F.col("rows").alias("x_rows"))
    second = chunks.select("cell", F.col("home").alias("y_home"), F.col("part").alias("y_part"), F.col("rows").alias("y_rows"))
    same = (F.col("y_home") & (F.col("x_part") == F.col("y_part"))).alias("same")
    met = blocks.join(first, ["cell", "x_part"]).join(second, ["cell", "y_home", "y_part"]).select("cell", same, "x_rows", "y_rows")
    return materialise(met.mapInArrow(compare, "vec_id long, links long, a long, b long"), "lattice-crowd-links")


def near_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector of ``vectors`` (vec_id, embedding)."""
    link = math.acos(cosine)
    units = materialise(_units(usable(vectors)), "lattice-units")
    gathered = _gathered(units, link / 2)
    cliques = materialise(_radii(gathered), "lattice-cliques")

    seats = _seats(units, gathered, cliques)
    taken = seats.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all"))
    crowded = materialise(taken.where(F.col("homes") * F.col("all") > CELL_PAIRS).select("cell"), "lattice-crowded")
    calm = seats.join(crowded, "cell", "left_anti")
    pairs, blocks = _meetings(calm.where("home"), calm), None
    if not crowded.isEmpty():
        crowd = materialise(seats.join(crowded, "cell", "left_semi"), "lattice-crowds")
        small, large = crowd.where(F.col("members") <= SMALL), crowd.where(F.col("members") > SMALL)
        marks = materialise(_marked(small), "lattice-marks")
        blocks = _crowded(small, marks, gathered, cosine)
        pairs = _apart(pairs.distinct(), marks).unionByName(_meetings(large.where("home"), crowd)).unionByName(_meetings(small.where("home"), large))
    pairs = pairs.distinct()
    judged = materialise(_judged(pairs, cliques, link), "lattice-judged")
    compared = materialise(_compared(judged.where(~F.col("whole")), gathered, cliques, cosine), "lattice-compared")

    whole = judged.where("whole").select("a", "b")
    ends = whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = ends.join(cliques.select(F.col("leader").alias("b"), "members"), "b").groupBy(F.col("a").alias("leader")).agg(F.sum("members").alias("more"))
    counted, edges = compared.select("vec_id", "links"), whole.unionByName(compared.select("a", "b").distinct())
    if blocks is not None:
        counted = counted.unionByName(blocks.where(F.col("vec_id").isNotNull()).select("vec_id", "links"))
        edges = edges.unionByName(blocks.where(F.col("a").isNotNull()).select("a", "b").distinct())
    single = counted.groupBy("vec_id").agg(F.sum("links").alias("single"))

    hub = cliques.select("leader", "hub")
    linked = edges.join(hub.withColumnsRenamed({"leader": "a", "hub": "x"}), "a").join(hub.withColumnsRenamed({"leader": "b", "hub": "y"}), "b")
    joined = components(linked.select(F.col("x").alias("a"), F.col("y").alias("b")))
    labels = hub.join(joined.withColumnRenamed("node", "hub"), "hub", "left").select("leader", F.coalesce("component", "hub").alias("component"))

    clique = cliques.select("leader", "members").join(labels, "leader").join(more, "leader", "left")
    known = gathered.select("vec_id", "leader").join(clique, "leader").join(single, "vec_id", "left")
    n_links = F.col("members") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("single", F.lit(0))
    known = known.select("vec_id", n_links.cast("long").alias("n_links"), F.col("component").alias("component_id"))
    every = vectors.select("vec_id").distinct().join(known, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    kept = F.coalesce(F.col("vec_id") == component, F.lit(True))
    return every.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))


#: DuckDB: links from all pairs, components by walking the links.
SQL = """
with recursive v as (select vec_id, min(embedding::double[]) as e from embeddings where vec_id is not null
    and embedding is not null and len(embedding) = len([x for x in embedding if isfinite(x)])
    and len([x for x in embedding if x <> 0]) > 0 group by vec_id),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as a, vec_id as b from v union select reach.a, links.b from reach join links on reach.b = links.a),
component as (select a, min(b) as c from reach group by a),
counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, coalesce(c, vec_id) as component_id, coalesce(c, vec_id) is not distinct from vec_id as kept
from (select distinct vec_id from embeddings) left join component on vec_id = component.a left join counted on vec_id = counted.a"""
