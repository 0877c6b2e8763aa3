"""Prefix trie of conversations, rolled up by bands of depths. DataFrame functions, but for one digest.

A node is a sequence of turns that some conversation begins with. Its key is a digest of the
running sums of its turns' digests (each taken with its place), so prefixes of one conversation
need no chain from turn to turn: the sums run over chunks of places, and a conversation that
holds a third of all turns spreads over many tasks.

Totals of subtrees come in rounds. A round takes the nodes at every ``height ** level``-th depth
and groups these depths into bands of ``height``. Nodes add to their ancestors within the band
only, so a node is copied ``height`` times at most, whatever the depth. The totals of the bands'
first nodes are then complete but for the bands below; they make up the trie of the next level,
and what that returns for each is added once to its ancestors in the band above. Rounds grow with
the logarithm of the depth.

Turns are ordered by number (null first), then role, then text. Cases: a null role or text is
empty; rows without conv_id are left out; equal rows are turns like others; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.windows import Level, row_numbers, running_windows
from tallymill.session import materialise

#: Turn numbers, and places, of a chunk.
CHUNK = 256
#: 32-bit words of a turn's digest (128 bits); their sums stay below 2 ** 63 for 2 ** 31 turns.
WORDS = 4
#: Ids in one row of the sorted lists that become a node's digest.
RUN = 4096
# What separates words.
BLANKS = r"[ \t-\r]+"


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text of every turn."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    chunk = F.floor(F.col("turn") / CHUNK)
    return row_numbers(turns, ["conv_id"], [F.col("turn"), F.col("role"), F.col("text")], [chunk], "place")


def grafted(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), role, text of conversations rebuilt on the openings of others.

    Of conversation ``c - c % 20`` come the first h turns (all if there are fewer), then c's own
    after its first h; h is crc32 of c's decimal text modulo 4. A conversation without any turn
    left gives one row with null depth. A base lends three turns at most to twenty conversations.
    """
    own = materialise(ordered(conversations), "trie-turns")
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4))
    heads = own.groupBy("conv_id").agg(F.max("place").alias("n_own")).withColumns(
        {"taken": taken, "base": F.col("conv_id") - F.col("conv_id") % 20}
    )
    lent = own.where("place <= 3").withColumnRenamed("conv_id", "base")
    lengths = lent.groupBy("base").agg(F.max("place").alias("n_base"))
    heads = heads.join(lengths, "base", "left").withColumn("lent", F.least("taken", F.coalesce("n_base", F.lit(0))))
    begin = heads.where("lent > 0").join(lent, "base").where("place <= lent")
    rest = own.where(F.col("place") > taken)
    # what a conversation borrows follows from its base, at most three turns: no window is needed
    borrowed = heads.select("conv_id", "lent")
    rest = rest.join(borrowed, "conv_id").withColumn("depth", F.col("place") - taken + F.col("lent"))
    none = heads.where((F.col("lent") == 0) & (F.col("n_own") <= F.col("taken")))
    empty = F.lit(None).cast("string")
    return (
        begin.select("conv_id", F.col("place").alias("depth"), "role", "text")
        .unionByName(rest.select("conv_id", "depth", "role", "text"))
        .unionByName(none.select("conv_id", F.lit(None).cast("long").alias("depth"), empty.alias("role"), empty.alias("text")))
    )


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat_ws(",", depth, *sums), 256), 1, 32))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 0), key, parent (key), words of every prefix of every conversation."""
    digest = F.sha2(F.concat_ws("\n", "depth", F.char_length("role"), "role", "text"), 256)
    parts = {f"w{i}": F.conv(F.substring(F.col("digest"), 8 * i + 1, 8), 16, 10).cast("long") for i in range(WORDS)}
    words = F.size(F.split("text", BLANKS)) - F.when(F.col("text").rlike(r"^[ \t-\r]"), 1).otherwise(0)
    words = words - F.when(F.col("text").rlike(r"[ \t-\r]\z"), 1).otherwise(0)
    words = F.when(F.col("text").rlike(r"[^ \t-\r]"), words).otherwise(0)
    turns = turns.where("depth is not null").withColumn("digest", digest).select(
        "conv_id", "depth", words.cast("long").alias("words"), *[c.alias(n) for n, c in parts.items()]
    )
    sums = Level(("conv_id",), sums={f"s{i}": f"w{i}" for i in range(WORDS)})
    run = running_windows(turns, [sums], [F.col("depth")], [F.floor(F.col("depth") / CHUNK)])
    totals = [F.col(f"s{i}") for i in range(WORDS)]
    before = [F.col(f"s{i}") - F.col(f"w{i}") for i in range(WORDS)]
    return run.select(
        "conv_id", "depth", _key(F.col("depth"), totals).alias("key"), _key(F.col("depth") - 1, before).alias("parent"), "words"
    )


def with_roots(turns: DataFrame) -> DataFrame:
    """The prefixes, that of no turns included for every conversation."""
    root = _key(F.lit(0).cast("long"), [F.lit(0).cast("long")] * WORDS)
    empty = turns.select("conv_id").distinct().select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        root.alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("words"),
    )
    return prefixes(turns).unionByName(empty)


@dataclass
class BandRollup:
    """Sums over subtrees of a trie whose nodes are prefixes.

    ``rows``: conv_id, depth, key and ``first``, true where the conversation stands for the node.
    """

    rows: DataFrame
    deepest: int
    height: int
    measures: list[str]

    def _sum(self, df: DataFrame) -> DataFrame:
        return df.groupBy("key").agg(*[F.sum(m).alias(m) for m in self.measures])

    def _paths(self, level: int) -> DataFrame:
        """key, ups (keys of ancestors within the band) and ``below``: true for the first
        nodes of the next band, whose ups are all of the band above; else ups include the node."""
        step, band = self.height**level, self.height ** (level + 1)
        block = F.floor(F.col("depth") / band)
        ends = (F.col("depth") % band == 0) & (F.col("depth") > 0)
        chains = (
            self.rows.where(F.col("depth") % step == 0)
            .withColumn("block", F.explode(F.when(ends, F.array(block - 1, block)).otherwise(F.array(block))))
            .groupBy("conv_id", "block")
            .agg(F.sort_array(F.collect_list(F.struct("depth", "key", "first"))).alias("chain"))
        )
        at = chains.select("block", "chain", F.posexplode("chain").alias("i", "at")).where("at.first")
        below = F.col("at.depth") == (F.col("block") + 1) * band
        length = F.col("i") + F.when(below, 0).otherwise(1)
        return at.select(
            F.col("at.key").alias("key"), F.slice(F.col("chain.key"), F.lit(1), length).alias("ups"), below.alias("below")
        )

    def _spread(self, paths: DataFrame, values: DataFrame) -> DataFrame:
        """What each node adds to each of its ups."""
        met = paths.join(values, "key")
        return met.select(F.explode("ups").alias("key"), *self.measures)

    def totals(self, values: DataFrame, level: int = 0) -> DataFrame:
        """key and sums over its subtree, for the nodes of ``values`` (key, measures)."""
        band = self.height ** (level + 1)
        paths = self._paths(level)
        if self.deepest < band:
            return self._sum(self._spread(paths, values))
        paths = materialise(paths, f"trie-paths-{level}")
        inside = self._sum(self._spread(paths.where("not below").drop("below"), values))
        inside = materialise(inside, f"trie-bands-{level}")
        firsts = self.rows.where((F.col("depth") % band == 0) & F.col("first")).select("key")
        complete = self.totals(inside.join(firsts, "key", "left_semi"), level + 1)
        above = self._spread(paths.where("below").drop("below"), complete)
        return self._sum(inside.unionByName(above))


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each key's ids, ascending and comma-joined.

    Ids are range-sorted over all tasks and written as runs of ``RUN`` ids, so that the digest,
    which cannot be split, reads one row for thousands of ids, a batch at a time.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if ids:
                arrays = [pa.array([key], pa.binary()), pa.array(ids[:1], pa.int64()), pa.array([",".join(map(str, ids))])]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "begin", "ids"])

        for batch in batches:
            for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if k != key or len(ids) == RUN:
                    yield from out()
                    key, ids = k, []
                ids.append(i)
        yield from out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    done += [(key, state.hexdigest())] * (key is not None)
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    spread = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    listed = spread.mapInArrow(runs, "key binary, begin long, ids string")
    gathered = listed.repartition("key").sortWithinPartitions("key", "begin")
    return gathered.mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, height: int = 8) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, depth from 1 without gaps, role, text;
    null depth: a conversation without turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (words of last texts that members share, over the subtree), ends_sha256.
    """
    rows = materialise(with_roots(turns), "trie-prefixes")
    deepest = rows.agg(F.max("depth")).first()[0]
    nodes = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.max("parent").alias("parent"),
    )
    nodes = materialise(nodes, "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    n_children = F.coalesce("n_children", F.lit(0).cast("long"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", n_children)
    values = nodes.select(
        "key",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    stands = nodes.select("conv_id", "depth", F.lit(True).alias("first"))
    marked = rows.select("conv_id", "depth", "key").join(stands, ["conv_id", "depth"], "left")
    marked = materialise(marked.withColumn("first", F.coalesce("first", F.lit(False))), "trie-marked")
    totals = BandRollup(marked, deepest or 0, height, ["n_leaves", "saved_tokens"]).totals(values)
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "key")).alias("last")).select("conv_id", "last.key")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(totals, "key", "left").join(_end_digests(materialise(last, "trie-ends")), "key", "left")
    return found.join(parents, "parent", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


_STEP = "list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(s, ''), lambda z: ascii(z)::bigint)),"
    " lambda a, b: {step}))"
).replace("{step}", _STEP.replace("[c,", "[xor(a, b),"))

#: DuckDB: the same rows, from lists of turns; every node meets every one of its ancestors.
SQL = f"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
  from conversations where conv_id is not null),
c as (select distinct conv_id, conv_id - conv_id % 20 as base, conv_id::varchar as s from t),
h as (select conv_id, base, {_CRC} % 4 as h from c),
r as (select h.conv_id, 0 as part, p, role, text from h join t on t.conv_id = base where p <= h
  union all select h.conv_id, 1, p, role, text from h join t using (conv_id) where p > h),
l as (select conv_id, list({{'role': role, 'text': text}} order by part, p) as turns from r group by conv_id),
f as (select h.conv_id, coalesce(turns, []) as turns from h left join l using (conv_id)),
m as (select conv_id, turns[1:d] as seq, d, d = len(turns) as ends from (select *, unnest(range(len(turns) + 1)) as d from f)),
n as (select seq, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from m group by seq, d),
k as (select seq[1:depth - 1] as seq, depth - 1 as depth, count(*) as n_children from n where depth > 0 group by all),
v as (select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * case when n.depth = 0 then 0 else
    len(regexp_extract_all(n.seq[n.depth].text, '[^\\x20\\x09-\\x0D]+')) end as saved
  from n left join k on n.seq = k.seq and n.depth = k.depth),
a as (select seq[1:up] as seq, up as depth, sum(saved)::bigint as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from (select *, unnest(range(depth + 1)) as up from v) group by all)
select v.conv_id, v.depth, u.conv_id as parent_conv_id, v.n_convs, v.n_children, a.n_leaves, a.saved_tokens, v.ends_sha256
from v join a on v.seq = a.seq and v.depth = a.depth
left join v as u on u.depth = v.depth - 1 and u.seq = v.seq[1:v.depth - 1]"""
