"""Personal data, source mix, preference pairs and the pipeline on small tables."""

from __future__ import annotations

import random
import time

import pytest
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from tallymill.llm import chat, mixing, pii
from tallymill.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, row string, mix_epoch long"
CARD = "4539578763621486"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s1", "kept", 7) for i, t in rows], DOCS)


ROWS = [
    (1, None),
    (2, ""),
    (3, "mail a.b@c.de, d@e_f@g.hi and x@y@z.com; bad@host"),
    (4, f"é {CARD} and 4539 5787 6362 1486, not {CARD[:-1]}0 or 1 2 3"),
    (5, "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.02.3.255"),
    (6, "call +1 (652) 555-5229 or +12 34 or +1234567890123456 now"),
    (7, "9" * 60_000 + "@" + "a." * 30_000 + "b"),
    (8, "1-2 3" * 20_000),
    (9, "same +1 652 555 5229, 4539578763621486"),
    (9, "same +1 652 555 5229, 4539578763621486"),
]


def test_base_spans_of_odd_rows(spark):
    from test_queries import plain_spans

    found = pii.find(docs(spark, ROWS), pii.NOTHING)
    for r in found.collect():
        own = [(k, s.start, s.end) for k in pii.KINDS for s in r[f"pii_{k}"]]
        assert own == plain_spans(r.row.text or ""), r.row.doc_id


def test_redaction_replaces_spans_and_keeps_columns(spark):
    table = docs(spark, ROWS)
    found = pii.redact(table, pii.NOTHING)
    assert found.columns == table.columns
    texts = {r.doc_id: r for r in found.collect()}
    assert (texts[1].text, texts[2].text, texts[1].row, texts[1].mix_epoch) == (None, "", "kept", 7)
    assert texts[3].text == "mail [EMAIL], d@e_f@g.hi and x@y@z.com; bad@host".replace("d@e_f@g.hi", "d@[EMAIL]").replace("x@y@z.com", "x@[EMAIL]")
    assert texts[4].text == f"é [CARD] and [CARD], not {CARD[:-1]}0 or 1 2 3"
    assert texts[6].text == "call [PHONE] or +12 34 or +1234567890123456 now"
    assert texts[9].text == "same [PHONE], [CARD]"
    assert found.count() == len(ROWS)


def test_selector_adds_rewritten_forms_only(spark):
    draw = random.Random(2)
    rows = []
    for i in range(400):
        number = f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"
        rows.append((i, f"word {number} word {'abcdefghij'[i % 10]}x@mail.example.com word {draw.randrange(10**15, 10**16)} and 3 of 17"))
    selector = pii.learn(docs(spark, rows))
    assert len(selector.trees) > 0
    asked = docs(spark, [(1, "write to ann (at) site(dot)org"), (2, "nothing of 2024-01-01 here 17 3"), (3, "mail b@c.de now")])
    spans = {r.doc_id: r.spans for r in pii.digests(asked, selector).collect()}
    assert spans[1].startswith("email:9:") and spans[2] == "" and spans[3] == "email:5:11"
    assert pii.learn(docs(spark, [])) == pii.NOTHING
    assert pii.digests(docs(spark, []), selector).collect() == []


def planted(draw, i):
    """A document's text, and its planted spans that the base rules do not find: (kind, start, end)."""
    mail = f"{draw.choice(['ann', 'joe', 'kim'])}{i}@{draw.choice(['mail', 'post'])}.example.org"
    ip = ".".join(str(draw.randrange(1, 255)) for _ in range(4))
    digits = f"{draw.randrange(10**14, 10**15)}"
    card = next(digits + c for c in "0123456789" if passes_luhn(digits + c))
    local = f"{draw.randrange(200, 999)}-{draw.randrange(1000, 9999)}"
    phone = f"+49 30 {draw.randrange(10**6, 10**7)}"
    base = [("write to", mail), ("from host", ip), ("charged to card", card), ("call", phone)]
    evasive = [
        ("email", "write to", mail.replace("@", " (at) ").replace(".", "(dot)")),
        ("email", "mail", mail.replace("@", "[at]")),
        ("ip", "from host", ip.replace(".", "[.]")),
        ("card", "charged to card", ".".join(card[j : j + 4] for j in range(0, 16, 4))),
        ("phone", "call", local),
        ("phone", "tel", phone.removeprefix("+49 ")),
    ]
    plain = [
        f"on {draw.randrange(1990, 2024)}-{draw.randrange(10, 13)}-{draw.randrange(10, 29)}",
        f"order {draw.randrange(10**6, 10**8)} shipped",
        f"lot {draw.randrange(10**14, 10**15)}{(int(card[-1]) + 1) % 10}",
        f"version {draw.randrange(300, 999)}.{draw.randrange(10)}.{draw.randrange(10)}.{draw.randrange(10)}",
        f"{draw.randrange(1000, 9999)} of {draw.randrange(1000, 9999)}",
        "meet at noon. then home",
    ]
    parts, spans = [], []
    for text in draw.sample(plain, 3):
        parts.append(text)
    if i % 2:
        parts += [f"{cue} {found}" for cue, found in draw.sample(base, 2)]
    else:
        kind, cue, found = draw.choice(evasive)
        parts.append((kind, cue, found))
    draw.shuffle(parts)
    text = ""
    for part in parts:
        text += " so " if text else ""
        if isinstance(part, tuple):
            kind, cue, found = part
            spans.append((kind, len(text) + len(cue) + 1, len(text) + len(cue) + 1 + len(found)))
            part = f"{cue} {found}"
        text += part
    return text, spans


def passes_luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def test_planted_rewritings_are_found_and_plain_numbers_left(spark):
    draw = random.Random(11)
    made = [planted(draw, i) for i in range(3_000)]
    table = docs(spark, [(i, text) for i, (text, _) in enumerate(made)])
    # the selector learns from documents with base spans; the planted ones carry no label
    selector = pii.learn(table.where("doc_id % 2 = 1"))
    found = pii.find(table.where("doc_id % 2 = 0"), selector)
    wanted = {(i, *s) for i, (_, spans) in enumerate(made) for s in spans}
    added = {(r.row.doc_id, k, s.start, s.end) for r in found.collect() for k in pii.KINDS for s in r[f"pii_added_{k}"]}
    right = wanted & added
    by_kind = {k: (sum(x[1] == k for x in right), sum(x[1] == k for x in wanted)) for k in pii.KINDS}
    assert len(right) >= 0.9 * len(wanted), (by_kind, sorted(wanted - added)[:20])
    assert len(right) >= 0.9 * len(added), (by_kind, sorted(added - wanted)[:20])
    assert all(hit >= 0.8 * total for hit, total in by_kind.values()), by_kind


def test_every_document_teaches_the_selector(spark, monkeypatch):
    fitted = []
    boost = pii.boost
    monkeypatch.setattr(pii, "boost", lambda patterns: fitted.extend(patterns) or boost(patterns))
    n = 21_000  # more than were sampled
    made = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("a"), F.col("id"), F.lit("@mail.example.org")).alias("text"))
    pii.learn(made.unionByName(spark.createDataFrame([(None, "no address"), (n, None)], "doc_id long, text string")))
    fit = made.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) != 0).count()
    assert sum(g for _, g, _ in fitted) == pytest.approx(2 * fit)  # each base span, and its rewritings as one


def test_rewritten_forms_are_proposed(spark):
    own = {"email": "ann.b@mail.example.org", "ip": "10.20.30.40", "card": "4539 5787 6362 1486", "phone": "+49 (30) 555-5229"}
    for kind, found in own.items():
        forms = pii.rewritten(kind, F.lit(found))
        assert len(forms) == pii.WAYS[kind]
        for form in forms:
            row = spark.range(1).select(form.alias("t")).select("t", pii._candidates(F.concat(F.lit("x: "), "t", F.lit(" so")), kind).alias("c")).first()
            assert [c.found for c in row.c] == [row.t], (kind, row)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 17, 1_000])
def test_running_sums(spark, size):
    steps = [(7 * i) % 11 for i in range(size)]
    df = spark.createDataFrame([(steps,)], "s array<int>")
    assert df.select(pii.running(F.col("s")).alias("r")).first().r == [sum(steps[: i + 1]) for i in range(size)]


def test_many_spans_in_one_text(spark):
    from test_queries import plain_spans

    text = " and ".join(f"a{i}@mail.example.org on 2024-01-{10 + i % 20} by +1 652 555 {1000 + i}" for i in range(4_000))
    selector = pii.learn(docs(spark, [(i, f"call +1 652 555 {1000 + i} or b{i}@c.de") for i in range(200)]))
    began = time.perf_counter()
    (r,) = pii.find(docs(spark, [(1, text)]), selector).collect()
    assert [(k, s.start, s.end) for k in pii.KINDS for s in r[f"pii_{k}"]] == plain_spans(text)
    assert time.perf_counter() - began < 20


def test_trees_separate_patterns():
    patterns = [((0, i % 5, i % 3), 10 * (i % 5 > 2), 10 * (i % 5 <= 2)) for i in range(15)]
    prior, trees = pii.boost(patterns)
    scores = {p[0]: prior + sum(t.score(p[0]) for t in trees) for p in patterns}
    assert min(v for k, v in scores.items() if k[1] > 2) > 0 > max(v for k, v in scores.items() if k[1] <= 2)
    assert pii.calibrate([(2.0, 9, 0), (1.0, 9, 9)], 0.98) == 2.0
    assert pii.calibrate([(2.0, 1, 0)], 0.98) == float("inf")
    assert pii.eased(9.0, [7.0, 9.0], 0.98) == 8.0 and pii.eased(float("inf"), [1.0], 0.98) == float("inf")
    assert 3.8 < pii.eased(9.0, [-9.0], 0.98) == pii.eased(2.0, [1.0], 0.98) < 3.9


def shares(capacity, budget, weights):
    """Plain water filling: give by weight, close full children, repeat."""
    given, live = {}, dict(capacity)
    while live:
        total = sum(weights.get(k, 1.0) for k in live)
        full = {k for k in live if live[k] <= budget * weights.get(k, 1.0) / total}
        if not full:
            return given | {k: int(budget * weights.get(k, 1.0) / total) for k in live}
        for k in full:
            given[k] = live.pop(k)
            budget -= given[k]
    return given


@pytest.mark.parametrize("percent", [0, 35, 90, 100, 200])
def test_mix_matches_plain_loops(spark, percent):
    draw = random.Random(percent)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else f"s{draw.randrange(3)}{draw.randrange(3)}"
        lang = draw.choice(["en", "de", None])
        rows.append((i if i % 50 else None, " ".join("w" * draw.randrange(40)) or None, lang, source if i % 17 else None, "r", 1))
    rows += [rows[1], rows[1]]
    weights = {"mix_lang": {"en": 3.0}, "mix_source": {"hot": 0.5}}
    found = mixing.select_mix(spark.createDataFrame(rows, DOCS), percent, 2, weights, 5).collect()

    import hashlib

    leaves, items = {}, {}
    for doc_id, text, lang, source, *_ in rows:
        source, lang = source or "unknown", lang or "unknown"
        leaf = (source[:-1] if source[-1].isdigit() else source, lang, source)
        n = len((text or "").split())
        leaves[leaf] = leaves.get(leaf, 0) + 2 * n
        for e in (0, 1):
            name = f"5:{e}:{'null' if doc_id is None else doc_id}"
            items.setdefault(leaf, []).append((e, hashlib.md5(name.encode()).hexdigest(), doc_id is not None, doc_id or 0, n))
    given = {(): sum(leaves.values()) // 2 * percent // 100}
    for depth, level in enumerate(mixing.LEVELS):
        below = {}
        for parent in [p for p in given if len(p) == depth]:
            children = {}
            for leaf, n in leaves.items():
                if leaf[:depth] == parent:
                    children[leaf[depth]] = children.get(leaf[depth], 0) + n
            below |= {(*parent, k): v for k, v in shares(children, given[parent], weights.get(level, {})).items()}
        given |= below
    expected = []
    for leaf, own in items.items():
        total = 0
        for e, _, _, doc_id, n in sorted(own):
            total += n
            if total > given[leaf]:
                break
            expected.append((*leaf, e, n))
    assert sorted((r.mix_domain, r.mix_lang, r.mix_source, r.mix_epoch, r.mix_tokens) for r in found) == sorted(expected)
    assert all(r.row.row == "r" and r.row.mix_epoch == 1 for r in found)


def test_mix_of_an_empty_table(spark):
    assert mixing.select_mix(docs(spark, [])).collect() == []


TURNS = "pair_id long, turn long, role string, text string"


def test_preference_pairs(spark):
    chosen = [(1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, "user", None), (2, 1, "user", "a"), (3, 5, None, "x"), (None, 1, "user", "z")]
    rejected = [(1, 1, "user", "hi"), (1, 2, "assistant", "nö"), (1, 2, "assistant", "nö"), (2, 1, "user", "a"), (4, 1, "assistant", "b")]
    frames = [spark.createDataFrame(x, TURNS) for x in (chosen, rejected)]
    found = {r.pair_id: tuple(r)[1:] for r in chat.preference(*frames).collect()}
    yes, no = "<|assistant|>\nyes<|end|>\n", "<|assistant|>\nnö<|end|>\n"
    assert found == {
        1: (1, "<|user|>\nhi<|end|>\n", yes + "<|user|>\n<|end|>\n", no + no, "14:24", "14:23,38:47"),
        2: (1, "<|user|>\na<|end|>\n", "", "", "", ""),
        3: (0, "", "<|unknown|>\nx<|end|>\n", "", "", ""),
        4: (0, "", "", "<|assistant|>\nb<|end|>\n", "", "14:22"),
    }
    assert chat.preference(*(f.limit(0) for f in frames)).collect() == []


def test_pipeline_stages_chain(spark):
    documents = table(spark, SF, "documents")
    now = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, SF)
        assert after.columns == documents.columns, name
        before, rows = now.collect(), after.collect()
        if name in ("language", "near_copies"):
            assert set(rows) <= set(before) and len(rows) > 0.8 * len(before)
        elif name == "personal_data":
            assert len(rows) == len(before) and {r.doc_id for r in rows} == {r.doc_id for r in before}
            assert any("[EMAIL]" in r.text for r in rows) and not any("@mail" in r.text for r in rows)
        else:
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before}
        now = spark.createDataFrame(rows, documents.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in now.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, last))


def test_pipeline_of_an_empty_table(spark):
    now = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        assert now.collect() == []
