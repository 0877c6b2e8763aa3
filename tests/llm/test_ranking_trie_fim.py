"""Pairwise quality ranking, conversation trie and fill-in-middle on unusual rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymill.llm import fim, ranking, trie
from tallymill.llm.queries import QUERIES

# --- fill-in-middle


def plain_units(text: str) -> list[str]:
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abZ <P>S\n1é😀") | st.characters(codec="utf-8"), max_size=80), st.integers(1, 20))
def test_unit_ends_in_any_block(text, block):
    ends = np.cumsum([len(x) for x in plain_units(text)]).tolist()
    assert list(fim.unit_ends(text)) == ends
    assert list(fim.unit_ends(text, block)) == ends


def test_a_text_beyond_the_block_is_cut_like_any_other():
    text = "ab c" * 200_000 + "x" * 600_000 + " end"
    n, form, a, b, out = fim.transform(text, 5, fim.Plan(cut_percent=100, suffix_first_percent=0))
    assert (n, form) == (len(plain_units(text)), "psm")
    prefix, rest = out[3:].split("<S>")
    suffix, middle = rest.split("<M>")
    assert prefix + middle + suffix == text and (len(prefix), len(middle)) == (a, b)


def test_fill_in_middle_on_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "has <M> in it", "c"), (4, "word", "d"), (None, "no id here", "e"), (7, "x < y <P or S>", "f"), (7, "x < y <P or S>", "f")]
    rows += [(i, "é" * i + " two\nlines " * (i % 7), "g") for i in range(100, 160)]
    rows.append((8, "ab c" * 100_000, "h"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    found = fim.fill_in_middle(docs)
    back = found.withColumn("back", fim.restored(found.output, found.form)).collect()
    assert sorted(r.back for r in back) == sorted(t or "" for _, t, _ in rows)
    by_id = {r.doc_id: r for r in back}
    assert [by_id[i].form for i in (1, 2, 3)] == ["plain"] * 3 and by_id[1].prefix_chars is None
    assert len([r for r in back if r.doc_id == 7]) == 2 and len({r.output for r in back if r.doc_id == 7}) == 1
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    digest = hashlib.sha256(b"1:null").hexdigest()
    n = len(plain_units("no id here"))
    cuts = sorted(int(digest[i : i + 8], 16) % (n + 1) for i in (0, 8))
    if by_id[None].form != "plain":
        assert by_id[None].prefix_chars == len("".join(plain_units("no id here")[: cuts[0]]))
    assert fim.digests(docs.limit(0)).collect() == []
    kept = fim.fill_in_middle(docs.withColumnRenamed("n", "output_of"), keys=("doc_id", "output_of"))
    assert kept.columns == ["doc_id", "output_of", "n", "form", "prefix_chars", "middle_chars", "output"]


# --- conversation trie


def plain_trie(conversations: dict) -> dict:
    """By (smallest member, depth): all columns of a node, from every prefix of every conversation."""
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for seq in members:
        if seq:
            children[seq[:-1]] = children.get(seq[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for seq, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", seq[-1][1])) if seq else 0
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += seq not in children
            saved[seq[:d]] += (len(own) - 1) * words
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return {
        (min(own), len(seq)): (
            min(members[seq[:-1]]) if seq else None, len(own), children.get(seq, 0), leaves[seq], saved[seq], sha(ends.get(seq, []))
        )
        for seq, own in members.items()
    }


def found_trie(df) -> dict:
    rows = df.collect()
    found = {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows
    }
    assert len(found) == len(rows)
    return found


def rebuilt(turns: list[tuple]) -> dict:
    own = {}
    for c, t, role, text in turns:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[: h[c]] + v[h[c] :] for c, v in own.items()}


def test_trie_of_odd_conversations(spark):
    draw = random.Random(3)
    turns = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["a b", " a\tb ", "", None, "c d"])) for c in range(0, 130) for t in range(draw.randrange(1, 5)) if c not in (20, 60)]
    turns += [(3, None, "user", "first"), (3, None, "user", "first"), (3, 1, "user", "tie"), (3, 1, "user", "a tie"), (None, 1, "user", "none")]
    turns += [(41, 0, "user", "x")]
    random.Random(1).shuffle(turns)
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, depth string")
    expected = plain_trie(rebuilt(turns))
    assert any(len(v) == 0 for v in rebuilt(turns).values())
    for height in (2, 8):
        assert found_trie(trie.prefix_trie(trie.grafted(df), height)) == expected
    assert trie.prefix_trie(trie.grafted(df.limit(0))).collect() == []


def test_deep_and_hot_conversations_roll_up_in_bands(spark):
    deep = [("user", f"turn {i}") for i in range(600)]
    chats = {c: deep[: c % 599] for c in range(0, 9_000, 37)} | {9_001: deep, 9_002: deep[:300] + [("user", "fork")] * 250}
    chats |= {c: [("user", "hi"), ("assistant", "same answer")] for c in range(20_000, 29_000)}
    rows = [(c, d, *turn) for c, turns in chats.items() for d, turn in enumerate(turns, 1)] + [(c, None, None, None) for c, t in chats.items() if not t]
    df = spark.createDataFrame(rows, "conv_id long, depth long, role string, text string")
    assert found_trie(trie.prefix_trie(df, height=4)) == plain_trie(chats)


def test_place_in_a_conversation_longer_than_a_chunk(spark):
    n = 3 * trie.CHUNK + 5
    rows = [(9, i // 2, "user", f"{i % 2} {i}") for i in range(n)]
    df = spark.createDataFrame(random.Random(4).sample(rows, n), "conv_id long, turn long, role string, text string")
    assert {(r.place, r.text) for r in trie.ordered(df).collect()} == {(i + 1, f"{i % 2} {i}") for i in range(n)}


# --- quality ranking


def test_held_out_quality(spark, duck):
    sf = SF.replace("0.001", "0.01")  # the smallest tables have no ten texts with label 0
    truth = dict(duck.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    n = duck.sql(f"select count(*) from '{sf}/documents.parquet'").fetchall()[0][0]
    found = QUERIES["op11_quality"](spark, sf).collect()
    assert len(found) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    held = [r for r in found if r.doc_id in truth and r.held_out]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)


def test_pair_weights_match_the_likelihood():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 3)) * [1, 10, 0]
    better, worse = x[:2000], x[2000:]
    swap = draw.random(2000) < 1 / (1 + np.exp((better - worse) @ [1.5, -0.1, 0]))
    better, worse = np.where(swap[:, None], worse, better), np.where(swap[:, None], better, worse)
    weights = ranking.fit(better, worse)
    assert np.allclose(weights, [1.5, -0.1, 0], atol=0.15) and weights[2] == 0
    diff = better - worse
    scale = np.sqrt((diff[:, :2] ** 2).mean(axis=0))
    slope = diff[:, :2].T @ (1 / (1 + np.exp(diff @ weights))) / scale - weights[:2] * scale
    assert np.abs(slope).max() < 1e-5


def test_cut_is_the_quantile_with_fewest_mistakes():
    scores, labels = np.array([1.0, 2.0, 3.0, 4.0, 5.0]), np.array([0, 0, 1, 0, 1])
    assert ranking.quantile_cut(scores, labels, np.ones(5)) == 2.5
    assert ranking.quantile_cut(scores, labels, np.array([1, 1, 1, 9, 1.0])) == 4.5
    assert ranking.quantile_cut(np.ones(4), np.array([0, 1, 1, 1]), np.ones(4)) == 0.0
    assert ranking.quantile_cut(np.ones(3), np.zeros(3), np.ones(3)) == 2.0


def test_ranking_of_odd_rows(spark):
    rows = [(i, f"Plain words number {i} and some more of them.", "x") for i in range(60)]
    rows += [(100 + i, f"$$$ {i} ### | | |\n" * 5, "x") for i in range(40)]
    rows += [(5, "another text of id five", "y"), (None, "no id", "z"), (200, None, "z"), (200, None, "z"), (201, "", "z"), (202, "word " * 100_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = [(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(40)] + [(7, 0), (7, 1), (None, 1), (8, None), (9, 5), (5, 1), (999, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, label int")
    ranker = ranking.learn(docs, labels)
    found = ranking.rank(docs, ranker).collect()
    assert len(found) == len(rows)
    scores = {r.doc_id: r.score for r in found}
    assert min(scores[i] for i in range(60) if i != 5) >= ranking.CUT > max(scores[100 + i] for i in range(40))
    assert all(0 <= s <= 1 for s in scores.values())
    kept = ranking.keep_ranked(docs, ranker)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(60)) - {5}
    assert ranking.learn(docs, labels.where("label = 1")) == ranking.NOTHING
    assert ranking.learn(docs.limit(0), labels) == ranking.NOTHING
    assert {r.score for r in ranking.rank(docs, ranking.NOTHING).collect()} == {ranking.UNKNOWN}
    assert ranking.rank(docs.limit(0), ranker).collect() == []


def test_pairs_grow_with_the_rows_only(spark):
    rows = [(i, int(i % 10 > 0), [float(i)]) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "doc_id long, label int, x array<double>")
    pairs = ranking.label_pairs(frame, 5_000).collect()
    assert 3_000 < len(pairs) < 6_000
    assert all(p.better[0] % 10 > 0 and p.worse[0] % 10 == 0 for p in pairs)
    assert len({p.worse[0] for p in pairs}) > 180


@pytest.mark.parametrize("text", ["", " ", "a", "!" * 9, "é" * 5, "one line\none line\n"])
def test_features_are_finite(text):
    x = ranking.features(text)
    assert len(x) == len(ranking.FEATURES) and np.isfinite(x).all()


def test_every_label_teaches(spark):
    # more of one label than were sampled
    n = 13_000
    rows = [(i, int(i % 100 > 0), [float(i % 7), float(i % 100 == 0)]) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, label int, x array<double>")
    named = frame.withColumn("x", F.array(F.col("doc_id").cast("double")))
    pairs = ranking.label_pairs(named, 20_000).collect()
    assert len(pairs) == n - n // 100
    assert {int(r.better[0]) for r in pairs} | {int(r.worse[0]) for r in pairs} == set(range(n))
    labels = frame.select("doc_id", "label")
    assert ranking.known_labels(labels.unionByName(spark.createDataFrame([(0, 1), (None, 1)], labels.schema))).count() == n - 1


def test_sums_over_tasks_equal_the_whole(spark):
    rng = np.random.default_rng(5)
    better, worse = rng.normal(0.5, 1, (700, 4)), rng.normal(0, 1, (700, 4))
    better[:, 3] = worse[:, 3] = 2.0
    pairs = spark.createDataFrame([(b.tolist(), w.tolist()) for b, w in zip(better, worse)], "better array<double>, worse array<double>").repartition(5)
    assert np.allclose(ranking.fit_pairs(pairs, 700), ranking.fit(better, worse), rtol=1e-6, atol=1e-9)
    for size, spread, bias in ((1, 3, 0), (400, 400, 0), (400, 30, 0), (400, 30, 40), (400, 30, -40), (300, 1, 0)):
        scores = rng.integers(0, spread, size).astype(float)
        labels = (scores + rng.normal(bias, spread / 4, size) > spread / 2).astype(int)
        weights = [2.5, 1.0]
        frame = spark.createDataFrame(list(zip(scores.tolist(), labels.tolist())), "score double, label int").repartition(3)
        assert ranking.quantile_cut_of(frame, weights) == ranking.quantile_cut(scores, labels, np.array(weights)[labels])
