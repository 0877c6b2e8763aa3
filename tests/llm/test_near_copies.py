"""Near copies of texts and vectors, nearest neighbours, components."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tallymill.llm import ann, lattice, minhash
from tallymill.llm.graph import components
from tallymill.llm.shingles import SEGMENT, shingles, word_hashes
from tallymill.session import materialise

DOCS = "doc_id long, text string, words string, weight int"
VECTORS = "vec_id long, embedding array<float>, leader string"


def union(nodes, links):
    parent = {i: i for i in nodes}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in nodes}


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_chains_stars_and_noise(spark, n):
    draw = random.Random(n)
    links = [(i, i + 1) for i in range(100, 100 + n)] + [(500, 501 + i) for i in range(n)]
    links += [(draw.randrange(1000, 1040), draw.randrange(1000, 1040)) for _ in range(20)]
    links += [(7, 7), (101, 100)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert found == {k: v for k, v in union(nodes, [x for x in links if x[0] != x[1]]).items()}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_word_hashes_do_not_depend_on_neighbours_or_segments():
    words = [f"w{i}" for i in range(SEGMENT // 4)]
    long = " ".join(words)
    assert len(long) > SEGMENT
    apart = np.concatenate([next(word_hashes([" ".join(words[i : i + 1000])])) for i in range(0, len(words), 1000)])
    together = list(word_hashes(["", "Ab c", long, "ab, C!", "…"]))
    assert (together[2] == apart).all()
    assert (together[1] == together[3]).all() and len(together[0]) == 0
    assert len(shingles(together[1])) == 1 and len(shingles(together[0])) == 0


def text(draw, n):
    return " ".join(draw.choice("abcdefgh") + str(draw.randrange(4000)) for _ in range(n))


def test_near_documents_of_hot_groups_and_odd_rows(spark):
    draw = random.Random(3)
    base = text(draw, 300).split()
    rows = [(i, " ".join(base)) for i in range(100, 180)]
    for i in range(200, 280):  # each differs in one word from the others' base
        rows.append((i, " ".join([*base[: i - 200], "other", *base[i - 199 :]])))
    rows += [(i, text(draw, 120)) for i in range(300, 360)]
    rows += [(1, None), (2, ""), (3, "!?"), (4, "!?"), (5, "one two"), (6, "One, two!"), (None, "one two"), (5, "one two")]
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], DOCS)
    found = {r.doc_id: r for r in minhash.near_groups(docs).collect()}
    assert set(found) == {i for i, _ in rows if i is not None}
    assert {found[i].component_id for i in range(100, 180)} == {found[i].component_id for i in range(200, 280)} == {100}
    assert all(found[i].component_id == i for i in [1, 2, 3, 4, 5, *range(300, 360)]) and found[6].component_id == 5
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == sorted(
        [(False, 0), *((True, i) for i in [1, 2, 3, 4, 5, 100, *range(300, 360)])]
    )


def test_near_documents_of_an_empty_table(spark):
    assert minhash.near_groups(spark.createDataFrame([], DOCS)).collect() == []


def test_draws_agree_as_often_as_the_similarity():
    rare = np.ones(1 << minhash.CELL_BITS, np.float32)
    draw = random.Random(1)
    agree, truth = [], []
    for _ in range(60):
        words = text(draw, 200).split()
        other = words[: draw.randrange(100, 200)] + text(draw, 30).split()
        a, b = (minhash.weighted(w, rare) for w in word_hashes([" ".join(words), " ".join(other)]))
        d = minhash.draws(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([0, len(a[0])]))
        agree.append((d[0] == d[1]).mean())
        truth.append(minhash.similarity(a, b))
    assert abs(np.mean(agree) - np.mean(truth)) < 0.03


def test_a_shingle_found_nowhere_else_weighs_twice_one_found_everywhere():
    words = next(word_hashes(["a few words of a text"]))
    common, rare = (minhash.weighted(words, np.full(1 << minhash.CELL_BITS, x, np.float32))[1] for x in (0, 1))
    assert np.allclose(rare, 2 * common)


def test_lattice_points_are_the_nearest():
    x = np.random.default_rng(0).normal(size=(300, 8)) * 2
    point = lattice.decode(x)
    step = lattice.shortest()
    assert step.shape == (240, 8) and np.allclose((step**2).sum(axis=1), 2)
    own = ((x - point) ** 2).sum(axis=1)
    assert (((x[:, None] - point[:, None] - step[None]) ** 2).sum(axis=2).min(axis=1) >= own - 1e-9).all()


def vectors(seed):
    draw = np.random.default_rng(seed)
    out = [(i, draw.normal(size=16)) for i in range(200)]
    centre = draw.normal(size=16)
    out += [(1000 + i, centre + draw.normal(size=16) * 0.12) for i in range(150)]  # some link, some do not
    out += [(2000 + i, centre * (i + 1)) for i in range(40)]
    return [(i, [float(x) for x in v], "x") for i, v in out]


ODD = [(1, None, ""), (2, [], ""), (3, [0.0] * 16, ""), (4, [float("nan")] * 16, ""), (5, [float("inf")] + [1.0] * 15, ""), (6, [None] * 16, "")]


def test_near_vectors_match_brute_force(spark):
    rows = vectors(1)
    odd = [(900_000 + i, v, x) for i, v, x in ODD]
    df = spark.createDataFrame([*rows, rows[0], *odd, (7_000_000, [1.0, 2.0], ""), (7_000_001, [1.0, 2.0], "")], VECTORS)
    found = {r.vec_id: r for r in lattice.near_vectors(df).collect()}
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    label = union(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(linked))])
    for i, n in zip(ids, linked.sum(axis=1)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (n, label[i], label[i] == i)
    assert all((found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True) for i, _, _ in odd)
    assert (found[7_000_001].n_links, found[7_000_001].component_id) == (1, 7_000_000)
    assert len(found) == len(ids) + len(odd) + 2


@pytest.mark.parametrize(("small", "chunk"), [(32, 512), (3, 100), (0, 512)])
def test_a_crowd_of_different_vectors_is_counted_in_blocks(spark, monkeypatch, small, chunk):
    monkeypatch.setattr(lattice, "SMALL", small)
    monkeypatch.setattr(lattice, "CHUNK", chunk)
    labels = []
    monkeypatch.setattr(lattice, "materialise", lambda df, label: labels.append((label, materialise(df, label))) or labels[-1][1])
    draw = np.random.default_rng(5)
    centre = draw.normal(size=64)
    centre /= np.linalg.norm(centre)
    x = [centre + draw.normal(size=64) * 0.0285 for _ in range(1200)]  # cosines about 0.95
    x += [x[k] + draw.normal(size=64) * 0.004 for k in range(5) for _ in range(60)]  # cliques within the crowd
    x += [-v for v in x[:3]] + [draw.normal(size=64) for _ in range(100)]
    ids = draw.permutation(len(x)).tolist()
    df = spark.createDataFrame([(i, [float(c) for c in v], "") for i, v in zip(ids, x)], VECTORS)
    found = {r.vec_id: r for r in lattice.near_vectors(df.repartition(4)).collect()}
    unit = np.array(x, dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = union(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(linked))])
    assert [found[i].n_links for i in ids] == linked.sum(axis=1).tolist()
    assert [found[i].component_id for i in ids] == [label[i] for i in ids]
    written = {label: df.count() for label, df in labels}
    if small == 32:  # the links of a block, not its pairs
        assert linked.sum() > 500_000 and written["lattice-judged"] < 50_000


def test_blocks_give_the_least_row_of_what_they_connect():
    linked = np.zeros((5, 4), bool)
    linked[[4, 4, 2, 1], [0, 3, 3, 2]] = True
    row, column = lattice._forest(linked)
    assert row.tolist() == [0, 1, 2, 3, 2] and column.tolist() == [2, 5, 1, 2]


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_nearest_by_cells_and_blocks(spark, monkeypatch, spread):
    """Many cells, cells of several blocks (copies that no split parts), blocks sent in several chunks."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 16)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, 16)) * 10
    x = centres[draw.integers(0, 12, 1_500)] + draw.normal(size=(1_500, 16)) * spread
    x[:300] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(df, F.col("vec_id") % 10 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 1_500, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(d)), d))[:10]
        rows = sorted(found[q])
        assert [r for r, _, _ in rows] == list(range(1, 11))
        assert all(abs(score - d[i]) < 1e-9 for _, i, score in rows)
        if q < 300:
            assert [i for _, i, _ in rows] == best.tolist()
        hits += len(set(best) & {i for _, i, _ in rows})
    assert hits >= 0.95 * 1_500, hits


def test_splits_place_every_point():
    points = np.random.default_rng(1).normal(size=(5_000, ann.DIMENSIONS))
    points[:2_000] = points[0]
    cells = ann.Splits(points, 4).cells(points)
    assert len(set(cells)) <= 16 and set(cells[:2_000]) == {cells[0]} and cells.min() >= 16 and cells.max() < 32


def test_nearest_of_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = vectors(2)
    df = spark.createDataFrame([*rows, rows[0], *ODD, (8, [1.0, 2.0], "")], VECTORS)
    found = ann.nearest(df, F.col("vec_id") % 100 == 0, k=5).collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        own = sorted((r.rank, r.vec_id) for r in found if r.query_id == q)
        assert [r[0] for r in own] == [1, 2, 3, 4, 5]
        hits += len(set(ids[np.lexsort((ids, d))[:5]].tolist()) & {v for _, v in own})
    assert hits >= 0.9 * len(found)
    few = ann.nearest(spark.createDataFrame(rows[:3], VECTORS), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.query_id) for r in few] == [(1, 0), (2, 0)]
    assert ann.nearest(spark.createDataFrame([], VECTORS), F.lit(True)).collect() == []


def test_chi_square_distribution():
    assert abs(ann.chi_square(ann.chi_square_quantile(0.99, 8), 8) - 0.99) < 1e-9
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 1e-2


@pytest.mark.parametrize("partitions", [1, 3, 4])
def test_rows_that_share_an_id_are_one_text_on_any_partitioning(spark, partitions):
    draw = random.Random(8)
    one, other = text(draw, 200), text(draw, 200)
    rows = [(1, one), (2, one + " more"), (2, other), (3, other + " more"), (4, None), (4, other + " end"), (4, "")]
    docs = spark.createDataFrame([(i, t, f"row {k}", k) for k, (i, t) in enumerate(rows)], DOCS)
    key = {t: k for t, k in docs.selectExpr("text", "xxhash64(text)").collect()}
    second = min((one + " more", other), key=key.__getitem__)
    found = {r.doc_id: r.component_id for r in minhash.near_groups(docs.repartition(partitions)).collect()}
    expected = {1: 1, 2: 1, 3: 3, 4: 3} if second != other else {1: 1, 2: 2, 3: 2, 4: 2}
    assert found == expected
    kept = {r.doc_id: r.text for r in minhash.keep_first(docs.repartition(partitions)).collect()}
    assert kept == ({1: one, 3: other + " more"} if second != other else {1: one, 2: other})
