"""Preference pairs as training text. DataFrame functions only.

The turns of a chosen and of a rejected conversation are compared in order; the turns both
begin with are rendered once, as the prompt. What follows in either is a completion, with
the places that count for training: the contents of assistant turns and their end marks.

Turns are ordered by number, then role, then text, nulls first. Cases: a null text is
empty and a null role is ``unknown``. If one conversation has no turns or both agree,
prompt or completions are empty. Repeated turns are turns like others. Turns of a pair
without an id are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks around a turn.
BEGIN, AFTER_ROLE, END, AFTER_TURN = "<|", "|>\n", "<|end|>", "\n"
TRAINED = "assistant"


def _numbered(turns: DataFrame, side: str) -> DataFrame:
    order = Window.partitionBy("pair_id").orderBy("turn", "role", "text")
    numbered = turns.where(F.col("pair_id").isNotNull()).withColumn("place", F.row_number().over(order))
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    return numbered.select("pair_id", "place", F.struct(role.alias("role"), text.alias("text")).alias(side))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), turn["role"], F.lit(AFTER_ROLE))


def _rendered(turn: Column) -> Column:
    return F.concat(_head(turn), turn["text"], F.lit(END + AFTER_TURN))


def _trained(turns: Column) -> Column:
    """start:end of the trained places in the rendered turns, in code points, comma-joined."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.char_length(_head(turn))
        end = start + F.char_length(turn["text"]) + len(END)
        place = F.concat_ws(":", start, end)
        found = F.when(turn["role"] == TRAINED, F.array_append(state["found"], place)).otherwise(state["found"])
        return F.struct((end + len(AFTER_TURN)).alias("at"), found.alias("found"))

    return F.array_join(F.aggregate(turns, begin, step, lambda state: state["found"]), ",")


def preference(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row a pair from its turns (pair_id, turn, role, text) on both sides.

    pair_id, n_common (turns in the prompt), prompt, chosen, rejected, chosen_trained, rejected_trained.
    """
    left, right = _numbered(chosen, "c"), _numbered(rejected, "r")
    turns = left.withColumn("r", F.lit(None).cast(right.schema["r"].dataType))
    turns = turns.unionByName(right.withColumn("c", F.lit(None).cast(left.schema["c"].dataType)))
    places = turns.groupBy("pair_id", "place").agg(F.max("c").alias("c"), F.max("r").alias("r"))
    parts = F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("place"))
    pairs = places.groupBy("pair_id").agg(
        F.min(parts).alias("fork"), F.sort_array(F.collect_list(F.struct("place", "c", "r"))).alias("turns")
    )
    before = F.filter("turns", lambda t: F.col("fork").isNull() | (t["place"] < F.col("fork")))
    after = F.filter("turns", lambda t: F.coalesce(t["place"] >= F.col("fork"), F.lit(False)))
    pairs = pairs.select(
        "pair_id",
        F.transform(before, lambda t: t["c"]).alias("common"),
        *(F.filter(_side(after, s), lambda turn: turn.isNotNull()).alias(s) for s in "cr"),
    )
    return pairs.select(
        "pair_id",
        F.size("common").cast("long").alias("n_common"),
        F.array_join(F.transform("common", _rendered), "").alias("prompt"),
        F.array_join(F.transform("c", _rendered), "").alias("chosen"),
        F.array_join(F.transform("r", _rendered), "").alias("rejected"),
        _trained(F.col("c")).alias("chosen_trained"),
        _trained(F.col("r")).alias("rejected_trained"),
    )


def _side(turns: Column, side: str) -> Column:
    return F.transform(turns, lambda t: t[side])


def echoed(conversations: DataFrame) -> DataFrame:
    """A worse twin of each conversation with an assistant turn (pair_id, turn, role, text):
    its last assistant turn repeats the text of the turn before it, or is empty as first turn."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = conversations.withColumns({"place": F.row_number().over(order), "said": F.lag("text").over(order)})
    last = F.max(F.when(F.col("role") == TRAINED, F.col("place"))).over(Window.partitionBy("conv_id"))
    placed = placed.withColumn("last", last).where(F.col("last").isNotNull())
    text = F.when(F.col("place") == F.col("last"), F.coalesce("said", F.lit(""))).otherwise(F.col("text"))
    return placed.select(F.col("conv_id").alias("pair_id"), F.col("place").alias("turn"), "role", text.alias("text"))


def echo_pairs(conversations: DataFrame) -> DataFrame:
    """Each conversation with an assistant turn as chosen, its echoing twin as rejected."""
    rejected = echoed(conversations)
    chosen = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    return preference(chosen.join(rejected.select("pair_id").distinct(), "pair_id", "left_semi"), rejected)


#: DuckDB: the same rows, by windows over numbered turns.
ECHO_SQL = f"""
with t as (select conv_id, coalesce(role, 'unknown') as rl, role, coalesce(text, '') as tx,
    row_number() over o as p, coalesce(lag(text) over o, '') as said
  from conversations where conv_id is not null
  window o as (partition by conv_id order by turn nulls first, role nulls first, text nulls first)),
l as (select *, max(case when role = '{TRAINED}' then p end) over (partition by conv_id) as last from t),
twins as (select conv_id, p, rl, tx, case when p = last then said else tx end as ty from l where last is not null),
f as (select *, min(case when tx <> ty then p end) over (partition by conv_id) as fork from twins),
r as (select conv_id, p, fork, rl,
    '{BEGIN}' || rl || '{AFTER_ROLE}' || tx || '{END}{AFTER_TURN}' as x,
    '{BEGIN}' || rl || '{AFTER_ROLE}' || ty || '{END}{AFTER_TURN}' as y,
    coalesce(p >= fork, false) as later, length('{BEGIN}' || rl || '{AFTER_ROLE}') as head from f),
a as (select *, sum(length(x)) over w - length(x) as ax, sum(length(y)) over w - length(y) as ay from r
  window w as (partition by conv_id, later order by p))
select conv_id as pair_id, count(*) filter (not later) as n_common,
  coalesce(string_agg(x, '' order by p) filter (not later), '') as prompt,
  coalesce(string_agg(x, '' order by p) filter (later), '') as chosen,
  coalesce(string_agg(y, '' order by p) filter (later), '') as rejected,
  coalesce(string_agg((ax + head) || ':' || (ax + length(x) - 1), ',' order by p) filter (later and rl = '{TRAINED}'), '') as chosen_trained,
  coalesce(string_agg((ay + head) || ':' || (ay + length(y) - 1), ',' order by p) filter (later and rl = '{TRAINED}'), '') as rejected_trained
from a group by conv_id"""
