"""The trie of conversations: which prefixes of turns are shared, by how many, and what sharing them saves.

A node is a distinct sequence of first turns; its members are the conversations that start with it. A prefix is known by the
exclusive or of its turns' 128-bit hashes, each hashed with its position, so prefixes come from running values over sorted rows
and a conversation of any length is never one value.

Subtrees are summed by the Euler tour technique. A node has an arc that enters it and one that leaves it; an arc's successor
in the tour follows from first children and next siblings. The list of arcs is ranked by splicing (``scan.list_ranks``), and
running sums along the tour give every subtree: the sum at the leaving arc less the sum before the entering arc.

Defined results: turns are ordered by turn (nulls first), then role, then the MD5 of the text, so ties have a fixed place and
repeated rows all count; a null role or text is empty; rows with a null conversation id are left out; an empty
table gives an empty result; other columns are not read. The digest of a node's ends is sequential by its nature: their ids are packed
into pieces by range, and the pieces of one node stream through one task in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm.registry import query, table
from linkcat.llm.scan import list_ranks, running
from linkcat.session import durable

WORD = r"[^\x20\x09-\x0D]+"
#: Ids in one piece of a node's list of ends.
PIECE = 16_384
KEY = ("depth", "k1", "k2")


def turn_rows(turns: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns without their texts: ``conv_id``, ``at`` (from 1), hashes ``a1`` and ``a2`` of role and text, and ``words`` of the text."""
    none = F.lit("")
    rows = turns.where(turns[id].isNotNull()).select(
        turns[id].cast("long").alias("conv_id"), turns[turn].alias("turn"), F.coalesce(turns[role], none).alias("role"), F.coalesce(turns[text], none).alias("text"))
    rows = durable(rows.select(
        "conv_id", "turn", "role", F.md5("text").alias("said"), F.xxhash64(F.lit(1), "role", "text").alias("a1"), F.xxhash64(F.lit(2), "role", "text").alias("a2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"), F.lit(1).cast("long").alias("one"), F.monotonically_increasing_id().alias("row")))
    return running(rows, "conv_id", ["turn", "role", "said", "row"], sums=["one"]).select("conv_id", F.col("one_upto").alias("at"), "a1", "a2", "words")


def rebuilt(rows: DataFrame, every: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """The turns of all conversations, and the ids of all, once the first turns of each are those of its leader.

    The leader of ``c`` is ``c - c % every``; the number of turns taken from it, and left out of the conversation's own, is
    ``crc32(c) % heads``. Leaders stay as they are.
    """
    rows = durable(rows)
    id = F.col("conv_id")
    own = rows.groupBy("conv_id").agg(F.max("at").alias("turns")).withColumn("leader", id - id % every)
    lengths = own.where("conv_id = leader").select("leader", F.col("turns").alias("there"))
    taken = F.crc32(id.cast("string").cast("binary")) % heads
    own = durable(own.join(lengths, "leader", "left").select(
        "conv_id", "leader", F.when(id == F.col("leader"), 0).otherwise(taken).alias("left_out"),
        F.when(id == F.col("leader"), 0).otherwise(F.least(taken, F.coalesce("there", F.lit(0)))).alias("taken")))
    first = rows.where((id % every == 0) & (F.col("at") < heads)).withColumnRenamed("conv_id", "leader")
    given = own.where("taken > 0").join(first, "leader").where("at <= taken").select("conv_id", F.col("at").alias("depth"), "a1", "a2", "words")
    kept = rows.join(own, "conv_id").where("at > left_out").select("conv_id", (F.col("at") - F.col("left_out") + F.col("taken")).alias("depth"), "a1", "a2", "words")
    return given.unionByName(kept), own.select("conv_id")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ends of one node, sorted by id, as pieces of comma-joined ids."""
    for batch in batches:
        columns = [np.asarray(batch.column(c)) for c in KEY]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        ids = batch.column("conv_id")
        cuts = np.append(np.flatnonzero(new), batch.num_rows)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            starts = np.arange(a, b, PIECE)
            texts = [",".join(map(str, ids.slice(s, min(PIECE, b - s)).to_pylist())) for s in starts]
            yield pa.RecordBatch.from_arrays([*(pa.array(np.full(len(starts), c[a])) for c in columns), ids.take(pa.array(starts)), pa.array(texts)], [*KEY, "first", "ids"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's pieces, which come one after the other."""
    key, state, done = None, None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
            if row[:3] == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = row[:3], hashlib.sha256()
            state.update(row[3].encode())
        if len(done) > 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "digest"), d, strict=True)) for d in done])
            done = []
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "digest"), d, strict=True)) for d in done])


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth``, ``k1``, ``k2`` and ``digest`` of the nodes at which the conversations of ``ends`` end."""
    order = [*KEY, "conv_id"]
    ranged = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_pack, "depth long, k1 long, k2 long, first long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digest, "depth long, k1 long, k2 long, digest string")


def tour(nodes: DataFrame) -> DataFrame:
    """The Euler tour of nodes ``id``, ``parent`` (-1: root), ``first_child`` and ``id_before`` (the sibling before, visited next): arcs ``id`` and ``next``.

    Arc ``2 id`` enters a node and ``2 id + 1`` leaves it.
    """
    enter = F.struct((2 * F.col("id")).alias("id"), F.coalesce(2 * F.col("first_child"), 2 * F.col("id") + 1).alias("next"))
    upward = F.when(F.col("parent") >= 0, 2 * F.col("parent") + 1)
    leave = F.struct((2 * F.col("id") + 1).alias("id"), F.coalesce(2 * F.col("id_before"), upward).alias("next"))
    return nodes.select(F.inline(F.array(enter, leave)))


def trie(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations given by turns ``conv_id``, ``depth`` (from 1), ``a1``, ``a2`` and ``words``.

    Columns: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    mixed = durable(steps.select("conv_id", "depth", "words", F.xxhash64("depth", "a1").alias("x1"), F.xxhash64("depth", "a2").alias("x2")))
    walked = running(mixed, "conv_id", ["depth"], xors=["x1", "x2"]).select("conv_id", "depth", "words", "x1", "x2", F.col("x1_upto").alias("k1"), F.col("x2_upto").alias("k2"))
    walked = durable(walked)
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "n_convs", "conv_id", zero.alias("words"), zero.alias("p1"), zero.alias("p2"))
    inner = walked.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("words").alias("words"),
        F.any_value(F.col("k1").bitwiseXOR(F.col("x1"))).alias("p1"), F.any_value(F.col("k2").bitwiseXOR(F.col("x2"))).alias("p2"))
    # Ids follow the conversations, so that the tour mostly goes on among neighbouring ids.
    ranged = root.unionByName(inner).repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    nodes = durable(ranged.withColumn("id", F.monotonically_increasing_id()))

    top = nodes.where("depth = 0").select("id", "conv_id").first()
    above = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    head = F.lit(top["id"] if top else None).cast("long")
    known: Column = F.when(F.col("depth") == 1, head)
    deep = nodes.where("depth > 1").join(above, ["depth", "p1", "p2"])
    flat = nodes.where("depth <= 1").withColumn("parent", F.coalesce(known, F.lit(-1))).withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(top["conv_id"] if top else None).cast("long")))
    linked = durable(deep.unionByName(flat).select("id", "parent", "parent_conv_id", "conv_id", *KEY, "n_convs", "words"))
    children = linked.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"), F.max("id").alias("first_child"))
    family = durable(running(linked, "parent", ["id"], lags=["id"]).join(children, "id", "left"))

    ranks = list_ranks(tour(family))
    leaf = F.when(F.col("first_child").isNull(), 1).otherwise(0).cast("long")
    weights = family.select((2 * F.col("id")).alias("id"), leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    arcs = durable(ranks.join(weights, "id", "left").fillna(0, ["leaves", "saved"]))
    summed = running(arcs, None, ["place"], sums=["leaves", "saved"])
    enters = F.col("id") % 2 == 0
    subtree = lambda c: F.sum(F.when(enters, F.col(c) - F.col(f"{c}_upto")).otherwise(F.col(f"{c}_upto")))
    subtrees = summed.groupBy(F.call_function("div", F.col("id"), F.lit(2)).alias("id")).agg(subtree("leaves").alias("n_leaves"), subtree("saved").alias("saved_tokens"))

    last = walked.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), "depth").alias("end")).select("conv_id", "end.*")
    turnless = conversations.join(last.select("conv_id"), "conv_id", "left_anti").select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"))
    digests = end_digests(durable(last.unionByName(turnless)))
    return family.join(subtrees, "id").join(digests, list(KEY), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


#: Every node's members, descendants and ends by comparing whole lists of turns; crc32 bit by bit.
SQL = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT DISTINCT c, c - c % 20 AS leader, CASE WHEN c % 20 = 0 THEN 0 ELSE xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 1, 2, 3, 4, 5, 6, 7]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT) % 4 END AS h FROM t),
r AS (SELECT h.c, t.role, t.text, 0 AS part, t.i FROM h JOIN t ON t.c = h.leader AND t.i <= h.h
  UNION ALL SELECT h.c, t.role, t.text, 1, t.i FROM h JOIN t ON t.c = h.c AND t.i > h.h),
l AS (SELECT h.c, coalesce(s, []) AS s FROM h LEFT JOIN (SELECT c, list({'role': role, 'text': text} ORDER BY part, i) AS s FROM r GROUP BY c) USING (c)),
p AS (SELECT c, d, s[1:d] AS s, d = len(s) AS ends FROM l, unnest(range(len(s) + 1)) u(d)),
n AS (SELECT s, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(s[d].text, '[^\x20\x09-\x0D]+')) END AS saved FROM p GROUP BY s, d),
k AS (SELECT s[1:d - 1] AS s, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
a AS (SELECT n.s, n.d, n.conv_id, n.n_convs, n.ends_sha256, n.saved, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON n.s = k.s),
b AS (SELECT a.s[1:u.d] AS s, sum((n_children = 0)::INTEGER) AS n_leaves, sum(saved) AS saved_tokens FROM a, unnest(range(len(a.s) + 1)) u(d) GROUP BY ALL)
SELECT a.conv_id, a.d AS depth, q.conv_id AS parent_conv_id, a.n_convs, a.n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, a.ends_sha256
FROM a JOIN b ON a.s = b.s LEFT JOIN n q ON a.d > 0 AND q.s = a.s[1:a.d - 1]
"""


@query("op13_prefix_trie", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, the first turns of each taken from the leader of its twenty."""
    steps, ids = rebuilt(turn_rows(table(spark, sf_dir, "conversations")), 20, 4)
    return trie(steps, ids)
