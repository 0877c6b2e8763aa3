"""The registered queries against their DuckDB statements, or else against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from conftest import SF, rows
from tokenizers import Tokenizer

from tallymill.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.sql("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    expected = duck.sql(SQL[name])
    assert sorted(expected.columns) == columns
    place = [expected.columns.index(c) for c in columns]
    assert rows(df) == sorted((tuple(r[i] for i in place) for r in expected.fetchall()), key=repr)


def test_token_counts(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = QUERIES["op5_token_counts"](spark, SF).collect()
    assert len(found) == len(documents)
    for r in found:
        n = len(library.encode(documents[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(documents[r.doc_id].encode()), n, n > 1024)


def test_bpe_round_trip(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = QUERIES["op6_bpe_round_trip"](spark, SF).collect()
    assert len(found) == len(documents)
    for r in found:
        ids = library.encode(documents[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0:
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m))
    return [(kind, m.start(), m.end()) for kind, m in found]


def test_personal_data(spark, documents):
    found = QUERIES["op2_personal_data"](spark, SF).collect()
    assert len(found) == len(documents)
    for r in found:
        spans = plain_spans(documents[r.doc_id])
        listed = [":".join(map(str, s)) for s in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert set(listed) <= set(r.spans.split(","))


def test_language_id_on_held_out_documents(spark, duck):
    truth = dict(duck.sql("select doc_id, lang from documents").fetchall())
    found = QUERIES["op4_language_id"](spark, SF).collect()
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_main_texts_are_the_articles(spark, duck):
    import html

    pages = dict(duck.sql("select page_id, html from pages").fetchall())
    found = QUERIES["op9_main_texts"](spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        lines = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", "\n", inner)).split("\n")
        lines = [" ".join(html.unescape(x).split()) for x in lines]
        assert (r.text, r.n_chars) == (text := "\n".join(filter(None, lines)), len(text))


def test_nearest_neighbours_reach_brute_force(spark, duck):
    table = duck.sql("select vec_id, embedding from embeddings").fetchall()
    ids, x = np.array([r[0] for r in table]), np.array([r[1] for r in table], dtype=float)
    found = QUERIES["op3_nearest_neighbours"](spark, SF).collect()
    hits = 0
    for q in ids[ids % 100 == 0]:
        distance = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        distance[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, distance))[:10]].tolist())
        own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 11))
        assert all(abs(score - distance[ids == v][0]) < 1e-12 for _, v, score in own)
        hits += len(best & {v for _, v, _ in own})
    assert hits >= 0.9 * len(found)


def test_near_documents_match_brute_force(spark, documents):
    from tallymill.llm import minhash

    found = {r.doc_id: r for r in QUERIES["op10_near_documents"](spark, SF).collect()}
    assert set(found) == set(documents)
    rare = minhash.rarity(spark.read.parquet(f"{SF}/documents.parquet"))
    ids = sorted(documents)
    weighted = [minhash.weighted(w, rare) for w in minhash.word_hashes([documents[i] for i in ids])]
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(ids):
        for j in range(i):
            if minhash.similarity(weighted[i], weighted[j]) >= 0.8:
                x, y = sorted((root(a), root(ids[j])))
                parent[y] = x
    assert {i: r.component_id for i, r in found.items()} == {i: root(i) for i in ids}
    assert all(r.kept == (i == r.component_id) for i, r in found.items())
