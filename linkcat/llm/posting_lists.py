"""Approximate nearest neighbours by inner product, over balanced posting lists.

* Centroids come from recursive k-means on a bounded sample (``SAMPLE`` vectors for each ``LISTS`` lists at most): a part
  with more than its share is split again, so lists stay balanced.
* A graph links every centroid with its nearest ones; a batched best-first search over it finds the centroids near a vector.
* Every vector is indexed: in the list of its nearest centroid, and, if it lies near a boundary, in those of other
  centroids that are hardly farther and not nearly the same as one already taken.
* A query walks the same graph: from its nearest centroids it opens one centroid after another that is at most so many times as
  far as the nearest, and reads the lists of all it has opened. The ratio is fitted: with it, the walk reads a share of ``TARGET``
  of the true neighbours of ``TRIED`` sampled queries, found by brute force in blocks.
* The nearest ``LEAST`` lists are read first; the other lists give only what is no worse than the best ``k + 1`` of these.

Inner products are searched as distances: a vector gets one more coordinate that brings all to the same length, a
query gets 0 there. Equal vectors are indexed once, with their ``k + 1`` smallest ids, and equal queries are searched once;
this loses nothing, since no other id of an equal vector can be among a query's nearest. Long lists are dealt
out in chunks, so no task holds a whole list of unbounded size. Queries that get fewer than ``k`` candidates read all lists.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors of
different lengths have no inner product, so each length is indexed and searched as a table of its own; rows with a null id take no part; rows that repeat id and
vector count once; ties go to the smaller id; fewer rows than ``k`` give all candidates; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linkcat.llm.registry import query, table
from linkcat.session import durable

#: Vectors a list should hold, most lists, and vectors of the sample for each list.
LIST_SIZE, LISTS, SAMPLE = 256, 16_384, 16
#: Bytes of that sample at most: the sample and the centroids go through the driver.
SAMPLE_BYTES = 1 << 27
NEIGHBOURS, BEAM = 32, 128
#: Boundary vectors: most copies, how much farther their other centroids may be, and how far apart, as shares of the vector's distances.
COPIES, NEAR, APART = 6, 1.12, 0.7
#: Lists that a query reads at least; the share of true neighbours to be read, the queries to fit that on, and a distance under which none is told apart.
LEAST, TARGET, TRIED, FLOOR = 8, 0.99, 256, 0.05
#: How much farther than the fitted ratio a walk goes.
WALK = 1.1
#: A chunk of a list has about so many vectors.
CHUNK = 8_192
#: Pairs of a vector and a list that are looked at together, pairs of which differences are made together, and bytes of the vectors that a
#: batch of placed rows repeats: a worker's memory does not grow with the number of lists.
CELLS, PAIRS, PLACED = 1 << 20, 1 << 15, 8 << 20
#: Bytes of the queries that search a chunk together, and how many more sampled queries than were seen may read a list.
ASKED, UNSEEN = 16 << 20, 3


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0)


def balanced_centroids(x: np.ndarray, leaf: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Means of the parts of ``x`` after splitting until a part has at most ``leaf`` vectors."""
    done, open_ = [], [x]
    while open_:
        part = open_.pop()
        k = min(8, -(-len(part) // leaf))
        if k <= 1 or not (part != part[0]).any():
            done.append(part.mean(0))
            continue
        centre = part[rng.choice(len(part), k, replace=False)]
        for _ in range(8):
            of = _distances(part, centre).argmin(1)
            centre = np.stack([part[of == j].mean(0) if (of == j).any() else part[rng.integers(len(part))] for j in range(k)])
        of = _distances(part, centre).argmin(1)
        parts = [p for j in range(k) if len(p := part[of == j])]
        if len(parts) == 1:
            done.append(part.mean(0))
        else:
            open_.extend(parts)
    return done


@dataclass
class Graph:
    """Centroids linked with their nearest ones."""

    centre: np.ndarray
    near: np.ndarray
    entry: np.ndarray
    longest: float
    probe: float = float("inf")
    #: Into how many slots the queries of a list are dealt.
    slots: np.ndarray | None = None

    @classmethod
    def build(cls, centre: np.ndarray, longest: float) -> Graph:
        n, degree = len(centre), min(NEIGHBOURS, len(centre) - 1)
        near = np.zeros((n, degree), np.int32)
        for low in range(0, n, 1024):
            d = _distances(centre[low : low + 1024], centre)
            d[np.arange(len(d)), np.arange(low, low + len(d))] = np.inf
            if degree:
                near[low : low + 1024] = np.argpartition(d, degree - 1, 1)[:, :degree]
        near = cls._both_ways(near)
        entry = np.unique(np.linspace(0, n - 1, min(n, 128)).astype(np.int32))  # parts of one split lie side by side, so these are spread out
        return cls(centre, near, entry, longest)

    @staticmethod
    def _both_ways(near: np.ndarray) -> np.ndarray:
        """The links with as many reverse ones, so that centroids which are nobody's nearest can be reached."""
        n, degree = near.shape
        if not degree:
            return near
        source, target = np.repeat(np.arange(n, dtype=np.int32), degree), near.ravel()
        order = np.argsort(target, kind="stable")
        first = np.searchsorted(target[order], np.arange(n + 1))
        place = np.arange(len(order)) - first[target[order]]
        back = np.repeat(near[:, :1], degree, axis=1)  # filled up with a link that is there already
        some = place < degree
        back[target[order][some], place[some]] = source[order][some]
        return np.concatenate([near, back], 1)

    def embed(self, x: np.ndarray, is_query: bool) -> np.ndarray:
        """Vectors where the nearest is the one of largest inner product."""
        x = x.astype(np.float32)
        if is_query:
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            return np.concatenate([x, np.zeros((len(x), 1), np.float32)], 1)
        x = x / np.float32(self.longest)
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))], 1).astype(np.float32)

    def nearest(self, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the ids and distances of the nearest centroids found, nearest first."""
        n, beam = len(x), min(max(BEAM, most), len(self.centre))
        rows = np.arange(n)[:, None]
        d = _distances(x, self.centre[self.entry])
        take = np.argsort(d, 1)[:, : min(8, d.shape[1])]
        ids = np.full((n, beam), -1, np.int32)
        dist = np.full((n, beam), np.inf, np.float32)
        ids[:, : take.shape[1]], dist[:, : take.shape[1]] = self.entry[take][:, :beam], d[rows, take][:, :beam]
        seen = np.zeros((n, len(self.centre)), bool)
        seen[rows, ids[:, : take.shape[1]]] = True
        opened = np.zeros((n, beam), bool)
        on = np.arange(n)
        while len(on) and self.near.shape[1]:
            waiting = np.where(opened[on] | (ids[on] < 0), np.inf, dist[on])
            at = np.argsort(waiting, 1)[:, :8]  # open the nearest that wait
            good = np.isfinite(np.take_along_axis(waiting, at, 1))
            on, at, good = on[good[:, 0]], at[good[:, 0]], good[good[:, 0]]
            if not len(on):
                break
            opened[on[:, None], at] |= good
            of, place = np.nonzero(good)
            new = self.near[ids[on[of], at[of, place]]]
            pairs = (of.astype(np.int64)[:, None] * len(self.centre) + new)[~seen[on[of][:, None], new]]
            of, new = np.divmod(np.unique(pairs), len(self.centre))  # distances only of centroids not met before, each once
            if not len(of):
                continue
            seen[on[of], new] = True
            place = np.arange(len(of)) - np.searchsorted(of, of)
            nd, ni = np.full((len(on), place.max() + 1), np.inf, np.float32), np.full((len(on), place.max() + 1), -1, np.int32)
            for low in range(0, len(of), PAIRS):
                to, centre = of[low : low + PAIRS], new[low : low + PAIRS]
                diff = self.centre[centre] - x[on[to]]
                nd[to, place[low : low + PAIRS]] = np.einsum("ij,ij->i", diff, diff)
            ni[of, place] = new
            all_d, all_i = np.concatenate([dist[on], nd], 1), np.concatenate([ids[on], ni], 1)
            all_o = np.concatenate([opened[on], np.zeros_like(nd, bool)], 1)
            best = np.argsort(all_d, 1, kind="stable")[:, :beam]
            dist[on], ids[on], opened[on] = (np.take_along_axis(a, best, 1) for a in (all_d, all_i, all_o))
            ids[on] = np.where(np.isfinite(dist[on]), ids[on], -1)
        return ids[:, :most], np.sqrt(dist[:, :most])

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vector and list of every copy in the index."""
        ids, d = self.nearest(self.embed(x, False), COPIES)
        keep = (ids >= 0) & (d <= NEAR * d[:, :1] + 1e-6)
        for j in range(1, ids.shape[1]):
            for i in range(j):  # a centroid much nearer to one already taken than to the vector adds little
                apart = np.linalg.norm(self.centre[ids[:, j]] - self.centre[ids[:, i]], axis=1)
                keep[:, j] &= ~keep[:, i] | (apart >= APART * d[:, j])
        row, col = np.nonzero(keep)
        return row, ids[row, col]

    def reach(self, x: np.ndarray, probe: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, centroid and ratio (to the distance of the nearest) of all centroids that a walk over the graph opens.

        The walk starts at the centroids nearest to a query and goes on from each whose ratio is at most ``WALK`` times ``probe``,
        so that it gets around gaps; those up to ``probe`` and the nearest ``LEAST`` are the result.
        """
        q = self.embed(x, True)
        first, d = self.nearest(q, LEAST)
        scale = np.maximum(d[:, :1], FLOOR)
        ratio = np.full((len(q), len(self.centre)), np.inf, np.float32)
        row, place = np.nonzero(first >= 0)
        col = first[row, place]
        ratio[row, col] = d[row, place] / scale[row, 0]
        seen = np.isfinite(ratio)
        start = seen.copy()
        while len(row) and self.near.shape[1]:
            fresh = np.zeros_like(seen)
            for low in range(0, len(row), PAIRS):
                of, at = row[low : low + PAIRS], col[low : low + PAIRS]
                fresh[of[:, None], self.near[at]] = True
            fresh &= ~seen
            seen |= fresh
            row, col = np.nonzero(fresh)
            for low in range(0, len(row), PAIRS):
                of, at = row[low : low + PAIRS], col[low : low + PAIRS]
                diff = self.centre[at] - q[of]
                ratio[of, at] = np.sqrt(np.einsum("ij,ij->i", diff, diff)) / scale[of, 0]
            on = ratio[row, col] <= WALK * probe
            row, col = row[on], col[on]
        row, col = np.nonzero(start | (ratio <= probe) & np.isfinite(ratio))
        return row, col, ratio[row, col]

    def _near_and_all(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, col, ratio = self.reach(x, self.probe)
        order = np.lexsort((ratio, row))
        rank = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        every, near = np.zeros((len(x), len(self.centre)), bool), np.zeros((len(x), len(self.centre)), bool)
        every[row, col] = True
        near[row[order][rank < LEAST], col[order][rank < LEAST]] = True
        return near, every

    def near_lists_for(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and list of every list to read first."""
        return np.nonzero(self._near_and_all(x)[0])

    def other_lists_for(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and list of every list to read then."""
        near, every = self._near_and_all(x)
        return np.nonzero(every & ~near)

    def all_lists_for(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and list of every list."""
        return np.nonzero(np.ones((len(x), len(self.centre)), bool))


def _whole(column: pa.ChunkedArray) -> pa.Array:
    """One array of a column."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def _place(held, how: str):
    """Rows once for each list that they belong to or read, with the list's number of slots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph: Graph = held.value
        for batch in batches:
            size = min(2048, max(1, CELLS // max(1, len(graph.centre))))
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, size)
                x = _matrix(part.column("v"))
                row, lists = getattr(graph, how)(x)
                step = max(1, PLACED // (8 * x.shape[1]))
                for first in range(0, len(row), step):
                    out, where = part.take(pa.array(row[first : first + step])), lists[first : first + step]
                    yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(graph.slots[where], pa.int32()), *out.columns], ["list", "slots", *out.schema.names])

    return run


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added from the first component to the last."""
    total = np.zeros(len(q))
    for i in range(q.shape[1]):
        total += q[:, i] * x[:, i]
    return total


def _nearest_of_all(held, k: int):
    """The best candidates of one task for each of the queries ``held``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = held.value
        scores, best = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0, q.shape[1]))
        for batch in batches:
            x = _matrix(batch.column("v"))
            for low in range(0, len(x), 4096):
                part = x[low : low + 4096]
                s = q @ part.T
                top = np.argpartition(-s, k, 1)[:, : k + 1] if s.shape[1] > k + 1 else np.tile(np.arange(s.shape[1]), (len(q), 1))
                scores, best = np.concatenate([scores, np.take_along_axis(s, top, 1)], 1), np.concatenate([best, part[top]], 1)
                top = np.argsort(-scores, 1, kind="stable")[:, : k + 1]
                scores, best = np.take_along_axis(scores, top, 1), np.take_along_axis(best, top[:, :, None], 1)
        asked = np.repeat(np.arange(len(q), dtype=np.int32), scores.shape[1])
        offsets = pa.array(np.arange(len(asked) + 1, dtype=np.int32) * q.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array(scores.ravel()), pa.ListArray.from_arrays(offsets, pa.array(best.ravel()))], ["asked", "score", "v"])

    return run


def _nearest_in_list(k: int):
    """The best candidates of one chunk for the queries that read it, without those worse than a query's ``bound``."""
    most = k + 4  # a few more than needed: products of whole blocks may differ in their last bits

    def run(_: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        asked, ids, scores, lists = [], [], [], _whole(right.column("ids"))
        if left.num_rows and right.num_rows:
            x, q = _matrix(_whole(right.column("v"))), _matrix(_whole(left.column("v")))
            longest = np.linalg.norm(x, axis=1).max()
            first, bounds = np.asarray(right.column("first")), np.asarray(left.column("bound"))
            for low in range(0, len(q), 512):
                part = q[low : low + 512]
                s = part @ x.T
                edge = bounds[low : low + 512]
                if s.shape[1] > most and np.isinf(edge).any():
                    edge = np.maximum(edge, np.partition(s, -most, 1)[:, -most])
                slack = 1e-9 * np.linalg.norm(part, axis=1) * longest
                good = s >= (edge - slack)[:, None]
                many = good.sum(1) > most
                if many.any() and s.shape[1] > most:  # a low bound must not pair a query with a whole chunk
                    edge = edge.copy()
                    edge[many] = np.maximum(edge[many], np.partition(s[many], -most, 1)[:, -most])
                    good[many] = s[many] >= (edge - slack)[many, None]
                row, col = np.nonzero(good)
                value = _exact(part[row], x[col])
                order = np.lexsort((first[col], -value, row))
                row, col, value = row[order], col[order], value[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                keep = rank < most
                asked.append(row[keep] + low)
                ids.append(col[keep])
                scores.append(value[keep])
        a, b = (np.concatenate(z).astype(np.int64) if z else np.zeros(0, np.int64) for z in (asked, ids))
        return pa.table({"qkey": _whole(left.column("key")).take(pa.array(a)), "key": _whole(right.column("key")).take(pa.array(b)),
                         "score": pa.array(np.concatenate(scores) if scores else np.zeros(0)), "ids": lists.take(pa.array(b)).cast(pa.list_(pa.int64()))})

    return run


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda e: e != 0)


def _groups(sizes: Column, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), sizes - 1)).alias(name)


def nearest_neighbours(vectors: DataFrame, queries: Column | str, *, id: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """The ``k`` rows of largest inner product for every row that ``queries`` marks, itself left out.

    Columns ``query_id``, ``rank`` from 1, ``id`` (named ``vec_id``) and ``score`` (in double precision, on the original vectors).
    """
    spark = vectors.sparkSession
    marked = F.expr(queries) if isinstance(queries, str) else queries
    rows = vectors.select(vectors[id].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v"), F.coalesce(marked, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("v")))
    lengths = rows.where("asks").select(F.size("v").alias("size")).distinct().orderBy("size").collect()
    found = [_search(rows.where(F.size("v") == r["size"]), r["size"], k) for r in lengths]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _search(rows: DataFrame, size: int, k: int) -> DataFrame:
    """The neighbours among vectors of one length: ``rows`` of id, v and asks."""
    spark = rows.sparkSession
    rows = rows.withColumn("key", F.concat_ws("-", F.hex(F.xxhash64("v")), F.hex(F.xxhash64(F.lit(1), "v"))))
    order = Window.partitionBy("key").orderBy("id")
    few = rows.select("key", "id", "v").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    classes = durable(few.groupBy("key").agg(F.any_value("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))
    total = classes.agg(F.count("*").alias("n"), F.max(norm).alias("longest")).first()
    most = max(1, SAMPLE_BYTES // (8 * size))
    lists = int(min(LISTS, max(1, total["n"] // LIST_SIZE), max(1, most // 4)))
    share = max(1, total["n"] // (lists * SAMPLE), -(-total["n"] // most))
    sample = classes.where(F.pmod(F.xxhash64("key"), F.lit(share)) == 0).select("key", "v").toArrow().sort_by("key")
    graph = _graph(_matrix(_whole(sample.column("v"))), lists, total["longest"] or 1.0)
    asking = rows.where("asks").select("key", "id").distinct()
    asked = rows.where("asks").groupBy("key").agg(F.any_value("v").alias("v"))
    graph.probe, shares = _fitted(graph, classes, asked, k)
    chunks = max(1, -(-total["n"] // (len(graph.centre) * CHUNK)))
    graph.slots = np.maximum(chunks, np.ceil(shares * asked.count() / max(1, ASKED // (8 * size)))).astype(np.int32)
    held = spark.sparkContext.broadcast(graph)

    where = T.StructType([T.StructField("list", T.IntegerType()), T.StructField("slots", T.IntegerType())])
    index = classes.select("key", "v", F.col("ids")[0].alias("first"), "ids")
    index = index.mapInArrow(_place(held, "lists_of"), T.StructType([*where.fields, *index.schema.fields]))
    index = index.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int")).withColumn("slot", _groups(F.col("slots"), "slot"))
    asked = asked.withColumn("bound", F.lit(float("-inf")))
    kind = T.StructType([*where.fields, *asked.schema.fields])
    need = k + 1
    near = _best(_hits(asked.mapInArrow(_place(held, "near_lists_for"), kind), index, chunks, k), k)
    full = near.where(F.size("best") >= need).select(F.col("qkey").alias("key"), F.col("best")[need - 1]["score"].alias("full"))
    bounded = asked.join(full, "key", "left").select("key", "v", F.coalesce("full", "bound").alias("bound"))
    others = _hits(bounded.mapInArrow(_place(held, "other_lists_for"), kind), index, chunks, k)
    found = _best(others.unionByName(near.select("qkey", F.explode("best").alias("b")).select("qkey", "b.score", "b.id")), k)

    short = asked.join(found.where(F.size("best") >= need).select(F.col("qkey").alias("key")), "key", "left_anti")
    best = found
    if len(graph.centre) > LEAST and not short.isEmpty():  # else all lists are read already
        every = short.mapInArrow(_place(held, "all_lists_for"), kind)
        best = found.where(F.size("best") >= need).unionByName(_best(_hits(every, index, chunks, k), k))
    out = asking.join(best.withColumnRenamed("qkey", "key"), "key")
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("id")), 1, k)
    ranked = out.select(F.col("id").alias("query_id"), F.posexplode(others).alias("place", "hit"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))


def _graph(sample: np.ndarray, lists: int, longest: float) -> Graph:
    rng = np.random.default_rng(5)
    x = Graph(np.zeros((1, 1)), np.zeros((1, 0), np.int32), np.zeros(1, np.int32), longest).embed(sample, False) if len(sample) else np.zeros((1, 2), np.float32)
    centre = np.stack(balanced_centroids(x, max(1, -(-len(x) // lists)), rng)).astype(np.float32)
    return Graph.build(centre, longest)


def _fitted(graph: Graph, classes: DataFrame, asked: DataFrame, k: int) -> tuple[float, np.ndarray]:
    """The distance ratio with which the lists read hold a share of ``TARGET`` of the true neighbours of sampled queries.

    And for each list the share of queries that read it at most, as far as the sample tells.
    """
    if len(graph.centre) <= LEAST:
        return float("inf"), np.ones(len(graph.centre))
    some = asked.orderBy(F.xxhash64("key")).limit(TRIED).toArrow()
    if not some.num_rows:
        return float("inf"), np.ones(len(graph.centre))
    q = _matrix(_whole(some.column("v")))
    probe = _fitted_ratio(graph, classes, q, k)
    reads = np.zeros(len(graph.centre))
    for low in range(0, len(q), 64):
        reads += np.bincount(graph.reach(q[low : low + 64], probe)[1], minlength=len(reads))
    return probe, np.minimum(1, (reads + UNSEEN) / len(q))


def _fitted_ratio(graph: Graph, classes: DataFrame, q: np.ndarray, k: int) -> float:
    """The ratio of ``_fitted`` for the sampled queries."""
    held = classes.sparkSession.sparkContext.broadcast(q)
    near = classes.select("v").mapInArrow(_nearest_of_all(held, k), "asked int, score double, v array<double>")
    order = Window.partitionBy("asked").orderBy(F.desc("score"))
    near = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).select("asked", "v").toArrow()
    of, x = np.asarray(near.column("asked")), _matrix(_whole(near.column("v")))
    other = (x != q[of]).any(1)
    of, x = of[other], x[other]
    if not len(x):
        return float("inf")
    lists_of = [graph.lists_of(x[low : low + 512]) for low in range(0, len(x), 512)]
    row, lists = (np.concatenate(c) for c in zip(*((r + 512 * i, li) for i, (r, li) in enumerate(lists_of)), strict=True))

    def read(probe: float) -> np.ndarray:
        """For each true neighbour the least ratio of a list that holds it, as far as the walk gets there."""
        ratio = np.full((len(q), len(graph.centre)), np.inf, np.float32)
        for low in range(0, len(q), 64):
            at, centre, far = graph.reach(q[low : low + 64], probe)
            ratio[at + low, centre] = far
        least = np.full(len(x), np.inf)
        np.minimum.at(least, row, ratio[of[row], lists])
        return least

    probe, share = float("inf"), TARGET
    least = read(probe)
    while np.isfinite(edge := np.quantile(least, share, method="higher")):  # a narrow walk may miss what a wide one reaches, so it is tried
        probe = float(edge) * (1 + 1e-6)
        if share >= 1 or np.isfinite(read(probe)).mean() >= TARGET:
            break
        probe, share = float("inf"), (1 + share) / 2 if share < 0.9999 else 1.0
    return probe


def _hits(routed: DataFrame, index: DataFrame, chunks: int, k: int) -> DataFrame:
    """For each query key and list the best ids with their scores; an id may come from several lists."""
    routed = routed.select("*", _groups(F.lit(chunks), "chunk")).withColumn("slot", F.pmod(F.xxhash64("key"), F.col("slots")).cast("int"))
    by = ["list", "chunk", "slot"]
    hits = routed.groupBy(by).cogroup(index.groupBy(by)).applyInArrow(_nearest_in_list(k), "qkey string, key string, score double, ids array<bigint>")
    once = hits.groupBy("qkey", "key").agg(F.max("score").alias("score"), F.any_value("ids").alias("ids"))
    return once.select("qkey", "score", F.explode("ids").alias("id"))


def _best(hits: DataFrame, k: int) -> DataFrame:
    """For each query key the ``k + 1`` best (score, id), best first."""
    flat = hits.groupBy("qkey", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("qkey").orderBy(F.desc("score"), "id")
    top = flat.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id", "score")))
    return durable(top.groupBy("qkey").agg(best.alias("best")))


@query("op2_posting_list_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings; queries are the rows whose id is divisible by 20."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")
