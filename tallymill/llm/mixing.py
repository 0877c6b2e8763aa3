"""Mixing sources to target weights by hierarchical budgeting. DataFrame functions only.

The leaves of a tree (domain, language, source) hold tokens. A budget goes from the root
down: each node divides what it has among its children by their weights, none getting more
than its leaves can give in ``epochs`` passes. What a child cannot take goes to its
siblings by their weights; since a node is given no more than its own leaves hold, only
what all siblings cannot take has moved to its ancestors' other children. A leaf then
takes a prefix, in tokens, of its seeded epochs: each epoch is all its documents in an
order drawn from seed, epoch and id.

No window holds a whole leaf: tokens are added up by leaf, epoch and hash bucket (the
first digits of the drawn order), running sums over buckets find the one bucket where the
budget ends, and only that bucket's documents are ordered.

Cases: null text has no tokens; a null language or source is ``unknown``; a null id draws
as the text ``null``. Documents with the same draw go by id, then by tokens. Repeated rows
each count and may each be taken. Children of weight 0 get nothing. Shares are rounded
down, so up to a token a node stays unspent. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.session import materialise

LEVELS = ("mix_domain", "mix_lang", "mix_source")
#: Hexadecimal digits of the draw that make a bucket: 16 to this power buckets an epoch.
BUCKET_DIGITS = 3


def token_count(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f]+")), F.lit(0)).cast("long")


def leaf_columns() -> dict[str, Column]:
    """Sources whose names differ in the last digit only form a domain."""
    source = F.coalesce(F.col("source"), F.lit("unknown"))
    return {
        "mix_domain": F.regexp_replace(source, "[0-9]$", ""),
        "mix_lang": F.coalesce(F.col("lang"), F.lit("unknown")),
        "mix_source": source,
    }


def draw(seed: int, epoch: Column) -> Column:
    """The place of a document in an epoch: a digest of seed, epoch and id."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), number))


def _place(epoch: Column, bucket: Column) -> Column:
    """Epoch and bucket as one text that sorts like them."""
    return F.concat(F.lpad(epoch.cast("string"), 9, "0"), F.lit(":"), bucket)


def allot(leaves: DataFrame, budget: int, weights: Mapping[str, Mapping[str, float]], levels: Sequence[str] = LEVELS) -> DataFrame:
    """``leaves`` (levels, capacity) with the tokens each is given (allotted).

    ``weights`` has for each level the weight of its values, 1 where none is given.
    """
    above, parents = [], None
    for level in levels:
        nodes = leaves.groupBy(*above, level).agg(F.sum("capacity").alias("capacity"))
        weight = F.lit(1.0)
        for value, w in weights.get(level, {}).items():
            weight = F.when(F.col(level) == value, float(w)).otherwise(weight)
        nodes = nodes.withColumn("weight", weight).where(F.col("weight") > 0)
        nodes = nodes.withColumn("given", F.lit(budget)) if parents is None else nodes.join(parents, above)
        siblings = Window.partitionBy(*(above or [F.lit(0)]))
        fullest = siblings.orderBy(F.col("capacity") / F.col("weight"), level)
        before = F.coalesce(F.sum("capacity").over(fullest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("weight").over(fullest.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        # tokens for each unit of weight if this child and those after it are not filled up
        nodes = nodes.withColumn("rate", (F.col("given") - before) / rest)
        full = F.col("capacity") / F.col("weight") <= F.col("rate")
        nodes = nodes.withColumn("full", full).withColumn("rate", F.max(F.when(~F.col("full"), F.col("rate"))).over(siblings))
        share = F.when(F.col("full"), F.col("capacity")).otherwise(F.floor(F.col("rate") * F.col("weight")))
        above = [*above, level]
        parents = nodes.select(*above, share.cast("long").alias("given"))
    return leaves.join(parents.withColumnRenamed("given", "allotted"), list(levels))


def select_mix(
    docs: DataFrame,
    share_percent: int = 60,
    epochs: int = 2,
    weights: Mapping[str, Mapping[str, float]] | None = None,
    seed: int = 17,
) -> DataFrame:
    """The rows of ``docs`` taken, once for each epoch that takes them.

    The budget is ``share_percent`` of all tokens. Columns: row (all columns of ``docs``),
    mix_domain, mix_lang, mix_source, mix_epoch and mix_tokens.
    """
    own = {**leaf_columns(), "mix_tokens": token_count(F.col("text"))}
    placed = docs.select(F.struct("*").alias("row"), "doc_id", *(c.alias(k) for k, c in own.items()))
    placed = placed.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    placed = placed.withColumn("mix_draw", draw(seed, F.col("mix_epoch")))
    placed = placed.withColumn("mix_bucket", F.substring("mix_draw", 1, BUCKET_DIGITS))

    sums = placed.groupBy(*LEVELS, "mix_epoch", "mix_bucket").agg(F.sum("mix_tokens").alias("tokens"))
    sums = materialise(sums, "mix-buckets")
    leaves = sums.groupBy(*LEVELS).agg(F.sum("tokens").alias("capacity"))
    total = sums.where(F.col("mix_epoch") == 0).agg(F.sum("tokens")).first()[0] or 0
    given = allot(leaves, total * share_percent // 100, weights or {})

    order = Window.partitionBy(*LEVELS).orderBy("mix_epoch", "mix_bucket")
    running = sums.withColumn("until", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    over = running.join(given.select(*LEVELS, "allotted"), list(LEVELS)).where(F.col("until") > F.col("allotted"))
    first = over.groupBy(*LEVELS).agg(
        F.min(F.struct("mix_epoch", "mix_bucket", (F.col("allotted") - F.col("until") + F.col("tokens")).alias("room"))).alias("cut")
    )
    cuts = given.select(*LEVELS).join(first, list(LEVELS), "left")
    cuts = cuts.select(
        *LEVELS,
        F.coalesce(_place(F.col("cut.mix_epoch"), F.col("cut.mix_bucket")), F.lit("~")).alias("cut"),
        F.coalesce("cut.room", F.lit(0)).alias("room"),
    )
    cuts = materialise(cuts, "mix-cuts")

    place = _place(F.col("mix_epoch"), F.col("mix_bucket"))
    met = placed.join(cuts.withColumnsRenamed({"cut": "mix_cut", "room": "mix_room"}), list(LEVELS))
    whole = met.where(place < F.col("mix_cut"))  # "~" is behind every place
    within = Window.partitionBy(*LEVELS, "mix_epoch").orderBy("mix_draw", "doc_id", "mix_tokens")
    so_far = F.sum("mix_tokens").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    part = met.where(place == F.col("mix_cut")).withColumn("mix_until", so_far).where(F.col("mix_until") <= F.col("mix_room"))
    columns = ["row", *LEVELS, "mix_epoch", "mix_tokens"]
    return whole.select(*columns).unionByName(part.select(*columns))


def mix_sql(share_percent: int, epochs: int, weights: Mapping[str, Mapping[str, float]], seed: int) -> str:
    """DuckDB: the same rows by plain windows over whole leaves."""
    steps, above = [], ""
    for i, level in enumerate(LEVELS):
        cases = "".join(f" when '{v}' then {float(w)!r}" for v, w in weights.get(level, {}).items())
        weight = f"case {level}{cases} else 1.0 end" if cases else "1.0"
        keys = f"{above}{level}"
        given = f"(select sum(n) * {share_percent} // 100 from docs)" if i == 0 else f"g{i - 1}.given"
        source = "leaves" if i == 0 else f"leaves join g{i - 1} using ({above.rstrip(', ')})"
        part = f"partition by {above.rstrip(', ')}" if i else ""
        steps.append(f"""
n{i} as (select {keys}, sum(capacity) capacity, ({weight})::double w, any_value({given}) given from {source} group by {keys}),
r{i} as (select *, (given - coalesce(sum(capacity) over (o rows between unbounded preceding and 1 preceding), 0))::double
  / sum(w) over (o rows between current row and unbounded following) rate
  from n{i} where w > 0 window o as ({part} order by capacity::double / w, {level})),
f{i} as (select *, capacity::double / w <= rate full_up from r{i}),
g{i} as (select {keys}, (case when full_up then capacity else
  floor(max(case when not full_up then rate end) over ({part}) * w) end)::bigint given from f{i})""")
        above = f"{keys}, "
    last = f"g{len(LEVELS) - 1}"
    return f"""
with docs as (select *, coalesce(source, 'unknown') mix_source, coalesce(lang, 'unknown') mix_lang,
    regexp_replace(coalesce(source, 'unknown'), '[0-9]$', '') mix_domain,
    coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')), 0)::bigint n from documents),
leaves as (select mix_domain, mix_lang, mix_source, sum(n) * {epochs} capacity from docs group by all),{",".join(steps)},
drawn as (select doc_id, mix_domain, mix_lang, mix_source, n, e::bigint epoch,
    md5('{seed}:' || e || ':' || coalesce(doc_id::varchar, 'null')) draw from docs, range({epochs}) t(e)),
placed as (select *, sum(n) over (partition by mix_domain, mix_lang, mix_source order by epoch, draw, doc_id, n
    rows between unbounded preceding and current row) until from drawn)
select doc_id, mix_domain as domain, mix_lang as lang, mix_source as source, epoch, n as n_tokens
from placed join {last} using (mix_domain, mix_lang, mix_source) where until <= given"""
