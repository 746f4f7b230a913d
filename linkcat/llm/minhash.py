"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard confirmation.

Two permutations of the 32-bit numbers make the whole signature: ``sigma`` scatters the shingles, and coordinate ``k``
is the smallest ``pi(sigma(shingle) + k)``, that is ``pi`` shifted circularly by ``k``. Signatures only nominate pairs;
a link counts once the Jaccard similarity of the two full shingle sets confirms it.

Equal sets are one class from the start. In every bucket (equal band) the member that collides most is compared with
all others; what then still lies in different components of one bucket is compared too, unless they share none of their
rarest elements, which rules similarity out. So no pair of a bucket is left open, and members of one component are never
paired again.

With 30 bands of 4 rows a pair of similarity 0.8 shares no band with a probability of 1.4e-7.

Defined results: null and empty texts and texts without words have ``n_shingles`` 0 and link with nothing; a text of
fewer words than the width is one shingle; documents with a null id link with nothing and are kept; repeated rows are
one class, and each gets the class's result; an empty table gives an empty result; other columns of the input are not
read, except by ``keep_first``, which returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkcat.llm import text as tx
from linkcat.llm.components import components
from linkcat.llm.registry import query, table
from linkcat.session import durable

BANDS, ROWS = 30, 4
_CHUNK = 1 << 15
U32 = np.uint32


def _scatter(x: np.ndarray) -> np.ndarray:
    """The permutation sigma of the 32-bit numbers."""
    x = (x ^ (x >> U32(16))) * U32(0x7FEB352D)
    x = (x ^ (x >> U32(15))) * U32(0x846CA68B)
    return x ^ (x >> U32(16))


def _permute(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The permutation pi of the 32-bit numbers, in place."""
    for shift, factor in ((17, 0xED5AD4BB), (11, 0xAC4C1B51), (15, 0x31848BAB)):
        np.right_shift(x, U32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, U32(factor), out=x)
    return x


def shingle_sets(words: tx.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin (and the end)."""
    hashes, first = words.hashes(), words.first
    start, values = tx.shingles(hashes, first, width)
    of = words.text[start] if len(start) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        whole = tx.run_hashes(hashes, first[short], first[short + 1], tx._WORDS)
        of, values = np.concatenate([of, short]), np.concatenate([values, whole])
    order = np.lexsort((values, of))
    of, values = of[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.searchsorted(of[new], np.arange(len(first)))


def signatures(values: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash signatures of the sets that ``first`` cuts from ``values``; every set has an element."""
    scattered = _scatter((values >> np.uint64(32)).astype(U32))
    out = np.full((size, len(first) - 1), 0xFFFFFFFF, U32)
    x, spare = np.empty(_CHUNK, U32), np.empty(_CHUNK, U32)
    for low in range(0, len(values), _CHUNK):
        part = scattered[low : low + _CHUNK]
        a = np.searchsorted(first, low, "right") - 1
        b = np.searchsorted(first, low + len(part), "left")
        cuts = np.maximum(first[a:b] - low, 0)
        v, w = x[: len(part)], spare[: len(part)]
        for k in range(size):
            np.add(part, U32(k), out=v)
            np.minimum(out[k, a:b], np.minimum.reduceat(_permute(v, w), cuts), out=out[k, a:b])
    return out


def _sign(width: int, bands: int, rows: int):
    def work(texts: pa.Array) -> dict[str, pa.Array]:
        words = tx.Words(*_lowered(texts), tx.NOT_SPACE)
        values, first = shingle_sets(words, width)
        n = np.diff(first)
        has = np.flatnonzero(n)
        none = n == 0
        keys = np.zeros((len(n), 2), np.uint64)
        band = np.zeros((len(n), bands), np.uint64)
        if len(has):
            starts = first[has]
            keys[has, 0] = np.add.reduceat(tx.mix(values), starts)
            keys[has, 1] = np.add.reduceat(tx.mix(values * np.uint64(0xD1342543DE82EF95) + np.uint64(1)), starts)
            found = signatures(values, np.append(starts, len(values)), bands * rows).astype(np.uint64)
            for j in range(bands):
                key = np.full(len(has), j + 1, np.uint64)
                for row in found[j * rows : (j + 1) * rows]:
                    key = tx.mix(key ^ row) + np.uint64(j + 1)
                band[has, j] = key
        raw = np.ascontiguousarray(keys).view(np.uint8).ravel()
        sets = pa.Array.from_buffers(pa.binary(16), len(n), [None, pa.py_buffer(raw)]).cast(pa.binary())
        mask = pa.array(none)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * bands, pa.int32()), pa.array(band.ravel().view(np.int64)))
        nothing = pa.array([None], lists.type)
        return {"n": pa.array(n, pa.int64()), "set_id": pa.compute.if_else(mask, None, sets), "bands": lists if not none.any() else pa.concat_arrays([nothing, lists]).take(pa.array(np.where(none, 0, np.arange(1, len(n) + 1))))}

    return lambda: work


def _lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tx.buffers(texts)
    return tx.LOWER[data], offsets


def _sets(width: int):
    def work(texts: pa.Array) -> dict[str, pa.Array]:
        values, first = shingle_sets(tx.Words(*_lowered(texts), tx.NOT_SPACE), width)
        return {"elements": tx.binary_array(values.view(np.uint8), first * 8).cast(pa.binary())}

    return lambda: work


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (tx.buffers(batch.column(name)) for name in ("left", "right"))
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(data[at[i] : at[i + 1]].tobytes(), np.uint64) for data, at in (left, right))
                place = np.searchsorted(a, b)
                common = int((a[np.minimum(place, len(a) - 1)] == b).sum())
                ok[i] = 100 * common >= percent * (len(a) + len(b) - common)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("left")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_similar(percent), "a long, b long")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each element of the sets."""
    for batch in batches:
        data, at = tx.buffers(batch.column("elements"))
        ids = np.repeat(np.asarray(batch.column("id")), np.diff(at) // 8)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.frombuffer(data.tobytes(), np.int64))], ["id", "x"])


def _open_pairs(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of bucket members in different components that may still be similar.

    A set of ``n`` elements that is similar to one of its bucket, of ``least`` elements or more, has at least ``a`` elements
    in common with it, so among its ``n - a + 1`` rarest elements there is one that is also among the other's rarest. Pairs are
    made on these elements only, and for each element only with sets outside its largest component. The rarest common element of two
    similar sets stands so early in both that enough elements follow it in each; elsewhere no pair is made.
    """
    parts = grouped.groupBy("band", "component").agg(F.count("*").alias("k"), F.min("n").alias("least"))
    mixed = parts.groupBy("band").agg(F.count("*").alias("parts"), F.min("least").alias("least")).where("parts > 1")
    open_ = grouped.join(mixed.select("band", "least"), "band").groupBy("rep").agg(
        F.any_value("n").alias("n"), F.any_value("component").alias("component"), F.min("least").alias("least"))
    common = F.greatest(F.ceil(percent * F.col("n") / 100), F.ceil(percent * (F.col("n") + F.col("least")) / (100 + percent)))
    open_ = durable(open_.select(F.col("rep").alias("id"), "n", "component", (F.col("n") - common + 1).alias("prefix")))
    here = sets.join(open_.select("id"), "id", "left_semi").mapInArrow(_elements, "id long, x long")
    frequency = here.groupBy("x").agg(F.count("*").alias("f"))
    order = Window.partitionBy("id").orderBy("f", "x")
    ranked = here.join(frequency, "x").withColumn("place", F.row_number().over(order))
    rare = durable(ranked.join(open_, "id").where("place <= prefix and f > 1").select("x", "f", "id", "n", "component", (F.col("n") - F.col("place") + 1).alias("rest")))
    # Elements of the same sets make the same pairs (those around one changed word do), so the rarest of them is enough.
    same = rare.groupBy("x").agg(F.any_value("f").alias("f"), F.count("*").alias("k"), F.bit_xor(F.xxhash64("id")).alias("g"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("h"))
    rare = rare.join(same.where("k > 1").groupBy("k", "g", "h").agg(F.min(F.struct("f", "x")).alias("first")).select("first.x"), "x")
    shares = rare.groupBy("x", "component").agg(F.count("*").alias("k")).groupBy("x").agg(
        F.max_by("component", "k").alias("most"), F.count("*").alias("parts")).where("parts > 1")
    able = rare.join(shares.select("x", "most"), "x")
    a, b = able.where("component <> most").alias("a"), able.alias("b")
    sizes = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent
    enough = F.least("a.rest", "b.rest") * (100 + percent) >= percent * (F.col("a.n") + F.col("b.n"))
    once = (F.col("b.component") == F.col("b.most")) | (F.col("a.id") < F.col("b.id"))
    pairs = a.join(b, (F.col("a.x") == F.col("b.x")) & (F.col("a.component") != F.col("b.component")) & sizes & enough & once)
    return pairs.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over links), ``kept``.

    Documents link if ``100 * |A and B| >= percent * |A or B|`` for their sets of ``width``-word shingles (words: runs of
    anything but white space, A-Z lower-cased). Ids are whole numbers and should be unique.
    """
    docs = docs.select(docs[id].cast("long").alias("id"), docs[text].alias("text"))
    signed = tx.add_columns(docs, "n long, set_id binary, bands array<long>", _sign(width, bands, rows))
    signed = durable(signed.select("row.id", "n", "set_id", "bands"))
    classes = signed.where("set_id is not null and id is not null").groupBy("set_id").agg(
        F.min("id").alias("rep"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))

    banded = classes.select("rep", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("m")).where("m > 1")
    members = durable(banded.join(shared, "band").select("band", "rep", "n", "m"))
    reps = members.select("rep").distinct()
    chosen = docs.join(reps.select(F.col("rep").alias("id")), "id", "left_semi")
    sets = tx.add_columns(chosen, "elements binary", _sets(width)).select("row.id", "elements")
    sets = durable(sets.join(signed.select("id", "n"), "id").where(F.length("elements") == 8 * F.col("n")).select("id", "elements").dropDuplicates(["id"]))

    weight = members.groupBy("rep").agg(F.sum("m").alias("weight"))
    centre = members.join(weight, "rep").groupBy("band").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("c"))
    nominated = members.join(centre, "band").where("rep <> c").select(F.col("rep").alias("a"), F.col("c").alias("b")).distinct()
    nominated = durable(nominated)
    links = durable(_confirm(nominated, sets, percent))

    grouped = members.join(components(links).withColumnRenamed("id", "rep"), "rep", "left").select(
        "band", "rep", "n", F.coalesce("component", "rep").alias("component"))
    rest = _open_pairs(grouped, sets, percent)
    done = nominated.unionByName(nominated.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = _confirm(rest.join(done, ["a", "b"], "left_anti"), sets, percent)

    found = components(links.unionByName(more))
    placed = classes.select("set_id", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_id", F.coalesce("component", "rep").alias("component"))
    known = F.col("id").isNotNull()
    out = signed.select("id", "n", "set_id").join(placed, "set_id", "left")
    component: Column = F.when(known, F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` less those of documents that are not the smallest id of their group; columns as they were.

    Rows that repeat an id and its text are one document, of which one row stays (texts told apart by 128 bits of hash), whatever
    their other columns. Rows of one id with different texts stay or go together. Rows with a null id all stay, as do empty and null
    texts of different ids; an empty table gives an empty one; other columns are handed on, whatever their names.
    """
    gone = near_duplicates(docs, id=id, text=text, **options).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    left = docs.join(gone, docs[id].cast("long") == gone["gone_id"], "left_anti")
    said = [docs[id].cast("long").alias("id"), F.xxhash64(docs[text]).alias("g"), F.xxhash64(F.lit(1), docs[text]).alias("h")]
    if docs.select(*said).where("id is not null").groupBy("id", "g", "h").count().where("count > 1").isEmpty():
        return left  # no row is repeated, so whole rows need not be shuffled to find that out
    known = left.where(left[id].isNotNull()).select(F.struct("*").alias("row"))
    key = [F.col("row")[id].cast("long").alias("id"), F.xxhash64(F.col("row")[text]).alias("g"), F.xxhash64(F.lit(1), F.col("row")[text]).alias("h")]
    return known.select("row", *key).dropDuplicates(["id", "g", "h"]).select("row.*").unionByName(left.where(left[id].isNull()))


#: Words by DuckDB's regular expressions; sets as lists; links from all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n, list_sort(sh) AS sh FROM s),
c AS (SELECT sh, min(doc_id) AS rep, any_value(n) AS n FROM n WHERE n > 0 GROUP BY sh),
e AS (SELECT rep, n, unnest(sh) AS x FROM c),
f AS (SELECT x FROM e GROUP BY x HAVING count(*) > 1),
g AS (SELECT e.* FROM e JOIN f USING (x)),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM g a JOIN g b ON a.x = b.x AND a.rep < b.rep AND least(a.n, b.n) * 100 >= 80 * greatest(a.n, b.n) GROUP BY a.rep, b.rep),
l AS (SELECT a, b FROM p WHERE 100 * i >= 80 * (na + nb - i)),
d AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT rep, rep FROM c UNION SELECT r.a, d.b FROM r JOIN d ON r.b = d.a),
m AS (SELECT a AS rep, min(b) AS component_id FROM r GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, coalesce(m.component_id, n.doc_id) AS component_id,
  n.doc_id = coalesce(m.component_id, n.doc_id) AS kept
FROM n LEFT JOIN c ON n.n > 0 AND n.sh = c.sh LEFT JOIN m ON c.rep = m.rep
"""


@query("op9_minhash_near_dedup", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, four-word shingles, similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"))
