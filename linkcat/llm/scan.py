"""Running sums over sorted rows that need no task to hold a whole key, and list ranking built of joins.

``running`` sorts the rows by range, so that a key of any size is spread over neighbouring partitions, sums inside each
partition, and then adds what the partitions before it leave of the same key. Only that table, of one row a partition, is
broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linkcat.session import durable

#: Items of a list that one task may rank; longer lists are shortened first.
LAST = 4_096
#: Items with neighbouring ids among which a task follows the list.
RUN = 200_000
#: Groups of a table that is broadcast; more are joined by shuffling.
BROADCAST_ROWS = 100_000


def bounded(groups: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table that is known to have few rows."""
    return F.broadcast(groups) if rows <= BROADCAST_ROWS else groups


def _scan(key: str | None, sums: Sequence[str], xors: Sequence[str], lags: Sequence[str]):
    """The values of each partition's rows, as if nothing came before the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, opening = TaskContext.get().partitionId(), 0, None, True
        carry = dict.fromkeys([*sums, *xors, *lags], np.int64(0))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.asarray(batch.column(key)) if key else np.zeros(n, np.int64)
            new = np.ones(n, bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = last is None or keys[0] != last
            heads, segment = np.flatnonzero(new), np.cumsum(new)
            out = []
            for name in sums:
                v = np.asarray(batch.column(name))
                total = np.cumsum(v)
                out.append(total - np.concatenate([[-carry[name]], (total - v)[heads]])[segment])
                carry[name] = out[-1][-1]
            for name in xors:
                v = np.asarray(batch.column(name))
                total = np.bitwise_xor.accumulate(v)
                out.append(total ^ np.concatenate([[carry[name]], (total ^ v)[heads]])[segment])
                carry[name] = out[-1][-1]
            arrays = [pa.array(v) for v in out]
            for name in lags:
                v = np.asarray(batch.column(name))
                arrays.append(pa.array(np.concatenate([[carry[name]], v[:-1]]), mask=new))
                carry[name] = v[-1]
            first = np.full(n, opening)
            if opening:
                first = segment <= int(at == 0)
                opening = bool(first[-1])
            arrays += [pa.array(first), pa.array(np.full(n, part)), pa.array(np.arange(at, at + n))]
            names = [f"{c}_upto" for c in (*sums, *xors)] + [f"{c}_before" for c in lags] + ["_opening", "_part", "_at"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])
            at, last = at + n, keys[-1]

    return run


def running(df: DataFrame, key: str | None, order: Sequence[str | Column], *, sums: Sequence[str] = (), xors: Sequence[str] = (), lags: Sequence[str] = ()) -> DataFrame:
    """Add ``<c>_upto``, the sum (or exclusive or) of a column over its key's rows up to each row, and ``<c>_before``, the value of the row before.

    ``key`` and the columns are longs without nulls; ``order`` is unique within a key. ``df`` is read twice, so it should be stored.
    """
    keys = [key] if key else []
    added = [T.StructField(f"{c}_upto", T.LongType()) for c in (*sums, *xors)] + [T.StructField(f"{c}_before", T.LongType()) for c in lags]
    added += [T.StructField("_opening", T.BooleanType()), T.StructField("_part", T.LongType()), T.StructField("_at", T.LongType())]
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    local = durable(ranged.mapInArrow(_scan(key, sums, xors, lags), T.StructType([*df.schema.fields, *added])))

    own = F.col(key) if key else F.lit(0).cast("long")
    left = [*[(c, F.sum, f"{c}_upto") for c in sums], *[(c, F.bit_xor, f"{c}_upto") for c in xors]]
    ends = local.groupBy("_part").agg(
        F.min_by(own, "_at").alias("first"), F.max_by(own, "_at").alias("last"),
        *[F.max_by(upto, "_at").alias(c) for c, _, upto in left], *[F.max_by(c, "_at").alias(f"_{c}") for c in lags])
    same = Window.partitionBy("last").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.select("_part", "first", F.struct("last", *[fn(c).over(same).alias(c) for c, fn, _ in left], *[F.col(f"_{c}") for c in lags]).alias("end"))
    carried = ends.withColumn("end", F.lag("end").over(Window.orderBy("_part"))).where(F.col("end.last") == F.col("first")).select("_part", "end")
    out = local.join(F.broadcast(carried), "_part", "left")
    more = {}
    for c in sums:
        more[f"{c}_upto"] = F.col(f"{c}_upto") + F.when(F.col("_opening"), F.coalesce(f"end.{c}", F.lit(0))).otherwise(0)
    for c in xors:
        more[f"{c}_upto"] = F.col(f"{c}_upto").bitwiseXOR(F.when(F.col("_opening"), F.coalesce(f"end.{c}", F.lit(0))).otherwise(F.lit(0)).cast("long"))
    for c in lags:
        more[f"{c}_before"] = F.coalesce(f"{c}_before", F.when(F.col("_at") == 0, F.col(f"end._{c}")))
    return out.withColumns(more).drop("end", "_opening", "_part", "_at")


def _rank_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    after, step = {}, {}
    for batch in batches:
        for i, j, w in zip(*(batch.column(c).to_pylist() for c in ("id", "next", "step")), strict=True):
            after[i], step[i] = j, w
    heads = set(after) - set(after.values())
    if not heads:
        return
    ids, places, place, at = [], [], 0, heads.pop()
    while at is not None:
        ids.append(at)
        places.append(place)
        place, at = place + step[at], after[at]
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(places, pa.int64())], ["id", "place"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow the list inside runs of ``RUN`` items: each item's first one before it in the run, and the way from there.

    The first items of such chains also get the chain's next item and its whole length.
    """
    def chains(table: pa.Table) -> pa.RecordBatch:
        ids = table.column("id").to_numpy()
        then = table.column("next").fill_null(-1).to_numpy()
        step = table.column("step").to_numpy().copy()
        order = np.argsort(ids)
        at = order[np.minimum(np.searchsorted(ids[order], then), len(ids) - 1)]
        inside = (then >= 0) & (ids[at] == then)
        head, away = np.arange(len(ids)), np.zeros(len(ids), np.int64)
        head[at[inside]] = np.flatnonzero(inside)
        away[at[inside]] = step[inside]
        while True:
            further = head[head]
            if (further == head).all():
                break
            head, away = further, away + away[head]
        tails = np.flatnonzero(~inside)
        last, whole = np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
        last[head[tails]], whole[head[tails]] = then[tails], away[tails] + step[tails]
        first = head == np.arange(len(ids))
        return pa.RecordBatch.from_arrays([
            pa.array(ids), pa.array(ids[head]), pa.array(away), pa.array(last, mask=~first | (last < 0)), pa.array(whole, mask=~first)],
            ["id", "before", "away", "next", "step"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= RUN:
            yield chains(pa.Table.from_batches(held))
            held, rows = [], 0
    if rows:
        yield chains(pa.Table.from_batches(held))


def list_ranks(items: DataFrame, last: int = LAST) -> DataFrame:
    """``id`` and ``place`` (from 0) of the items of one linked list with columns ``id`` (0 or more) and ``next`` (null at its end).

    First the list is followed inside runs of items with neighbouring ids, which leaves the first item of each chain. Then a
    round takes out the items whose random number is smaller than that of both their neighbours, about a third, and
    lengthens the steps over them; no two neighbours go at once. The few items that are left at last are ranked in one task,
    and then each round's items find their places behind their predecessors. All rounds together cost a few times one join of
    the list, and ids that follow the list's order make them cheap.
    """
    items = items.select("id", "next", F.lit(1).cast("long").alias("step"))
    chains = durable(items.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(_contract, "id long, before long, away long, next long, step long"))
    rounds = [chains.where("id <> before").select("id", "before", "away")]
    items = chains.where("id = before").select("id", "next", "step")
    while items.count() > last:
        draw = lambda c: F.xxhash64(F.lit(len(rounds)), c)  # noqa: E731, B023
        before = items.select(F.col("id").alias("before"), F.col("next").alias("id"), F.col("step").alias("away"))
        lower = (draw("id") < draw("before")) & (F.col("next").isNull() | (draw("id") < draw("next")))
        out = durable(before.join(items, "id").where(lower))
        over = out.select(F.col("before").alias("id"), F.col("next").alias("then"), (F.col("away") + F.col("step")).alias("far"))
        kept = items.join(out.select("id"), "id", "left_anti").join(over, "id", "left")
        items = durable(kept.select("id", F.when(F.col("far").isNull(), F.col("next")).otherwise(F.col("then")).alias("next"), F.coalesce("far", "step").alias("step")))
        rounds.append(out.select("id", "before", "away"))
    ranked = items.repartition(1).mapInArrow(_rank_few, "id long, place long")
    for i, out in enumerate(reversed(rounds)):
        placed = out.join(ranked.withColumnRenamed("id", "before"), "before").select("id", (F.col("place") + F.col("away")).alias("place"))
        ranked = ranked.unionByName(placed)
        if i % 3 == 2:
            ranked = durable(ranked)
    return ranked
