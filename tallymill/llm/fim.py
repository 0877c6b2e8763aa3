"""Fill-in-middle: texts cut in three at two units and put in another order.

A text is a row of units, words of letters or single other characters. One full match of
``(unit)*`` keeps every repetition of its group, so the ends of the repetitions give the number
of units and both cuts. Texts beyond ``BLOCK`` characters, for which the matcher's own memory
would not do, are matched block by block; blocks end after a character that is no letter, so
their units are those of the whole text.

Everything drawn depends on a digest of the seed and the id: repeated rows are cut alike, on
every run. Cases: a null text is empty; an empty text, or one that holds a mark, stays plain; a
null id draws as the word ``null``; a text of one unit has empty parts. Further columns are
ignored unless named as ``keys``. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import per_batch, texts

UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
NO_LETTER = regex.compile(r"[^A-Za-z]")
#: Characters that one match takes.
BLOCK = 1 << 18
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Plan:
    """How often a text is cut at all, and how often the suffix then comes first."""

    seed: str = "1"
    cut_percent: int = 90
    suffix_first_percent: int = 20


def unit_ends(text: str, block: int = BLOCK) -> Sequence[int]:
    """End of every unit, in characters."""
    if len(text) <= block:
        return UNITS.fullmatch(text).ends(1)
    ends, start = [], 0
    while start < len(text):
        last = NO_LETTER.search(text, min(start + block, len(text)) - 1)
        stop = last.end() if last else len(text)
        ends.append(np.array(UNITS.fullmatch(text, start, stop).ends(1)))
        start = stop
    return np.concatenate(ends)


def transform(text: str, doc_id: int | None, plan: Plan) -> tuple:
    """n, form, prefix_chars, middle_chars and the output of one text."""
    digest = hashlib.sha256(f"{plan.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    first, second, cut, order = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    ends = unit_ends(text)
    n = len(ends)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or cut % 100 >= plan.cut_percent:
        return n, "plain", None, None, text
    a, b = (int(ends[k - 1]) if k else 0 for k in sorted((first % (n + 1), second % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < plan.suffix_first_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, plan: Plan = Plan(), keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys`` of every row of ``docs`` (doc_id, text) with n, form, prefix_chars, middle_chars, output.

    One pass, no shuffle; a task holds one batch of texts.
    """
    slim = docs.select(F.struct(*keys).alias("kept"), F.col("doc_id").alias("drawn_by"), "text")
    kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
    schema = slim.select("kept").schema
    for name, kind in kinds.items():
        schema = schema.add(name, "string" if kind == pa.string() else "long")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = [transform(t, i, plan) for t, i in zip(texts(batch), batch.column("drawn_by").to_pylist())]
        made = [pa.array(x, kind) for x, kind in zip(zip(*done), kinds.values())]
        return pa.RecordBatch.from_arrays([batch.column("kept"), *made], names=["kept", *kinds])

    return per_batch(slim, cut, schema).select("kept.*", *kinds)


def restored(output: Column, form: Column) -> Column:
    """The text that was cut, from the output and its form.

    No mark occurs in the parts, and none begins with the end of another, so the first
    occurrence of a mark is the mark itself.
    """
    def after(part: Column, mark: str) -> Column:
        return F.substr(part, F.locate(mark, part) + len(mark))

    def between(first: str, second: str) -> Column:
        return F.substring_index(after(output, first), second, 1)

    psm = F.concat(between(PREFIX, SUFFIX), after(output, MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(output, MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Counts of every row, with the digests of its output and of what that restores to."""
    cut = fill_in_middle(docs, plan)
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def digest_sql(plan: Plan = Plan()) -> str:
    """DuckDB: the same rows, from lists of units."""
    draws = ", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::bigint as h{i + 1}" for i in range(4))
    marks = " or ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
with d as (select doc_id, coalesce(text, '') as t,
    sha256('{plan.seed}:' || coalesce(doc_id::varchar, 'null')) as h from documents),
u as (select doc_id, t, {draws}, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as units from d),
n as (select *, len(units)::bigint as n, case when t = '' or {marks} or h3 % 100 >= {plan.cut_percent} then 'plain'
    when h4 % 100 < {plan.suffix_first_percent} then 'spm' else 'psm' end as form from u),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b from n),
p as (select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle,
    array_to_string(units[b + 1:], '') as suffix from c)
select doc_id, n, form,
  case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    when 'spm' then '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle else t end) as output_sha256,
  sha256(t) as restored_sha256
from p"""
