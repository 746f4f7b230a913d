"""Removal of passages that repeat across or inside documents, by super-k-mer partitioning.

A window is ``width`` consecutive words. Its minimiser is the smallest hash among its runs of ``MINIMISER`` words, so
equal windows have equal minimisers. Consecutive windows of a document that share their minimiser form one super-k-mer:
their words travel once, as one packed string, to the bucket of the minimiser. In a bucket the windows are cut out
again and sorted by a 128-bit hash, which brings equal ones together and finds the first of them.

* Inside a slice of texts only the first window of equal ones travels; the others are known to repeat.
* Minimisers that are frequent in a sample of at most ``SAMPLE`` documents (expected) rank behind all others. That only
  spreads the windows around a very frequent passage over many buckets; which windows are equal doesn't depend on it.
* Buckets are as many as ``BUCKET_BYTES`` of text ask for, so a bucket keeps its size when the input grows.

Defined results: null texts have no words; a text of fewer words than the width keeps them all; "earlier" compares ids
as whole numbers, a null id comes after all ids; windows with the same id and start (repeated rows) are not earlier than
each other, so repeated rows are judged alike; an empty table gives an empty result; columns of any name are kept by
``clean``, as the operator works beside the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table

WIDTH = 20
MINIMISER = 3
BUCKET_BYTES = 4 << 20
SLICE_BYTES = 2 << 20
SAMPLE = 20_000
#: A minimiser with as many super-k-mers in the sample is frequent.
FREQUENT = 50
_LAST_ID = (1 << 63) - 1
_TOP = np.uint64(1 << 63)


def _minimisers(hashes: np.ndarray, start: np.ndarray, width: int, hot: np.ndarray) -> np.ndarray:
    """The minimiser of each window; frequent ones rank last."""
    m = min(MINIMISER, width)
    at = np.arange(len(hashes) - m + 1)
    value = tx.run_hashes(hashes, at, at + m, tx._WORDS) >> np.uint64(1)
    if len(hot):
        place = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
        value = np.where(hot[place] == value, value | _TOP, value)
    span, have = width - m + 1, 1
    while 2 * have <= span:
        value = np.minimum(value[:-have], value[have:])
        have *= 2
    if have < span:
        value = np.minimum(value[: len(value) - (span - have)], value[span - have :])
    return value[start]


def _later(first: np.ndarray, second: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows have an equal one with a smaller (doc, start); equal windows agree in both hashes."""
    out = np.zeros(len(first), bool)
    order = np.argsort(first)
    same = first[order[1:]] == first[order[:-1]]
    some = np.zeros(len(first), bool)
    some[1:] |= same
    some[:-1] |= same
    found = order[some]
    if len(found):
        found = found[np.lexsort((start[found], doc[found], second[found], first[found]))]
        new = np.ones(len(found), bool)
        new[1:] = (first[found[1:]] != first[found[:-1]]) | (second[found[1:]] != second[found[:-1]])
        lead = found[np.maximum.accumulate(np.where(new, np.arange(len(found)), 0))]
        out[found] = (doc[found] != doc[lead]) | (start[found] != start[lead])
    return out


def _runs(mask: np.ndarray, of: np.ndarray, value: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the runs of marked neighbours of the same text (and value)."""
    at = np.flatnonzero(mask)
    if not len(at):
        return at, at
    cut = np.ones(len(at), bool)
    cut[1:] = (np.diff(at) != 1) | (of[at[1:]] != of[at[:-1]])
    if value is not None:
        cut[1:] |= value[at[1:]] != value[at[:-1]]
    begin = np.flatnonzero(cut)
    return at[begin], np.diff(np.append(begin, len(at)))


def _pack(width: int, buckets: int, hot: np.ndarray):
    """Slices of texts to one compressed payload for each bucket."""
    squeeze = zstandard.ZstdCompressor(level=3)

    def work(ids: np.ndarray, keys: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, bytes]]:
        words = tx.Words(data, offsets, tx.NOT_SPACE)
        hashes, doc_of = words.hashes(), words.text
        start, one = tx.shingles(hashes, words.first, width)
        if not len(start):
            return
        _, two = tx.shingles(hashes, words.first, width, second=True)
        of = doc_of[start]
        place = start - words.first[of]
        later = _later(one, two, ids[of], place)
        value = _minimisers(hashes, start, width, hot)
        begin, size = _runs(~later, of, value)
        gone, gone_size = _runs(later, of)
        joined, at = words.joined()
        view = memoryview(joined)
        target = np.concatenate([tx.mix(value[begin]) % np.uint64(buckets), tx.mix(value[gone]) % np.uint64(buckets)]).astype(np.int64)
        begin, size = np.concatenate([begin, gone]), np.concatenate([size, gone_size])
        travels = np.arange(len(begin)) < len(begin) - len(gone)
        order = np.lexsort((of[begin], ~travels, target))
        cuts = np.flatnonzero(np.diff(target[order], prepend=-1))
        for low, high in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            part = order[low:high]
            b, n, sent = begin[part], size[part], int(travels[part].sum())
            first, last = start[b[:sent]], start[b[:sent]] + n[:sent] + width - 1
            text = b"".join([view[x:y] for x, y in zip(at[first].tolist(), at[last].tolist(), strict=True)])
            head = np.array([len(part), sent], np.int64).tobytes()
            fields = (ids[of[b]].astype(np.int64), keys[of[b]].astype(np.uint32), place[b].astype(np.int32), n.astype(np.int32))
            yield int(target[part[0]]), squeeze.compress(b"".join([head, *(x.tobytes() for x in fields), text]))

    return work


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of ``id``, ``key``, ``text``."""
    for batch in batches:
        ids, keys = (np.asarray(batch.column(c).fill_null(0)).astype(np.int64) for c in ("id", "key"))
        data, offsets = tx.buffers(batch.column("text"))
        for low, high in tx.slices(offsets, SLICE_BYTES):
            yield ids[low:high], keys[low:high], data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def _send(width: int, buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _pack(width, buckets, hot)
        for part in _batches(batches):
            rows = list(work(*part))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "payload"])
        tx.give_back()

    return run


def _sampled(width: int):
    """The minimisers of the super-k-mers of a sample, with their numbers by slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, data, offsets in _batches(batches):
            words = tx.Words(data, offsets, tx.NOT_SPACE)
            start, _ = tx.shingles(words.hashes(), words.first, width)
            if len(start):
                value = _minimisers(words.hashes(), start, width, np.zeros(0, np.uint64))
                begin, _ = _runs(np.ones(len(start), bool), words.text[start], value)
                value, n = np.unique(value[begin], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(n)], ["value", "n"])
        tx.give_back()

    return run


def _word_hashes(text: memoryview) -> np.ndarray:
    """Hashes of the words of a payload, each followed by one space."""
    data = np.frombuffer(text, np.uint8)
    return tx.Words(data, np.array([0, len(data)]), np.arange(256) != 0x20).hashes()


def _unpack(raw: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A payload as runs and windows; nothing of its words is kept.

    Runs are rows of id, key, place and size, those that are known to repeat and those that travelled; windows are rows of both
    hashes of each window of the latter.
    """
    count, sent = np.frombuffer(raw, np.int64, 2)
    at, fields = 16, []
    for kind in (np.int64, np.uint32, np.int32, np.int32):
        values = np.frombuffer(raw, kind, count, at)
        at += values.nbytes
        fields.append(values.astype(np.int64))
    runs = np.stack(fields)
    if not sent:
        return runs, runs[:, :0], np.zeros((2, 0), np.uint64)
    words = _word_hashes(memoryview(raw)[at:])
    first = np.concatenate([[0], np.cumsum(runs[3, :sent] + width - 1)])
    windows = np.stack([tx.shingles(words, first, width, second=second)[1] for second in (False, True)])
    return runs[:, sent:], runs[:, :sent], windows


def _bucket(width: int):
    """The repeated windows of one bucket, as runs of window starts."""
    def found(rows: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        parts = [_unpack(open_.decompress(payload.as_py()), width) for payload in rows.column("payload")]
        done, sent, windows = (np.concatenate(x, axis=1) for x in zip(*parts, strict=True))
        del parts
        ids, keys, place, size = sent
        of = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + place[of]
        mask = _later(*windows, ids[of], at)
        begin, n = _runs(mask, of)
        out = [np.concatenate([a, b]) for a, b in zip((ids[of[begin]], keys[of[begin]], at[begin], n), done, strict=True)]
        return pa.table(dict(zip(("id", "key", "start", "n"), map(pa.array, out), strict=True)))

    def run(_: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        table = found(rows)
        tx.give_back()
        return table

    return run


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Runs of windows that also start earlier: ``id``, ``key``, ``start`` (word of the first window), ``n`` (windows).

    ``docs`` has the columns ``id`` (never null), ``key`` (CRC-32 of the text) and ``text``.
    """
    spark = docs.sparkSession
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size["bytes"] or 0) // BUCKET_BYTES))
    share = max(1, -(-size["n"] // SAMPLE))
    sample = docs.where(F.pmod(F.xxhash64("id", "key"), F.lit(share)) == 0)
    counted = sample.mapInArrow(_sampled(width), "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    hot = np.array(sorted(r["value"] for r in counted.where(F.col("n") >= FREQUENT).collect()), np.uint64)
    sent = docs.mapInArrow(_send(width, buckets, hot), "bucket int, payload binary")
    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_bucket(width), "id long, key long, start long, n long")


def _cut(width: int):
    """Words of each text, those covered by its runs, and the kept ones joined by a space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tx.buffers(batch.column("row").field("text"))
            runs = batch.column("runs").fill_null([]) if batch.column("runs").null_count else batch.column("runs")
            for low, high in tx.slices(offsets):
                words = tx.Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], tx.NOT_SPACE)
                part = runs.slice(low, high - low)
                pairs = part.flatten()
                per = np.diff(np.asarray(part.offsets))
                begin = words.first[np.repeat(np.arange(high - low), per)] + np.asarray(pairs.field("start"))
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + np.asarray(pairs.field("n")) + width - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (words.counts > 0)
                joined, at = words.joined()
                keep = ~gone
                last = np.flatnonzero(keep)
                bytes_of = np.repeat(keep, np.diff(at))
                if len(last):  # no space after the last kept word of a text
                    ends = last[np.append(np.diff(words.text[last]) != 0, True)]
                    bytes_of[at[ends + 1] - 1] = False
                total = np.concatenate([[0], np.cumsum(bytes_of)])
                kept = tx.binary_array(joined[bytes_of], total[at[words.first]], pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(low, high - low), pa.array(words.counts), pa.array(removed), kept], ["row", "n_words", "n_removed", "kept"])
        tx.give_back()

    return run


def cut_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Each row of ``docs`` as the struct ``row`` (``id``, ``key``, ``text``, ``rest``) with ``n_words``, ``n_removed`` and ``kept``.

    Removed are the words covered by a window that also starts earlier (smaller id, or same document and earlier start);
    ``kept`` joins the other words by one space.
    """
    keyed = docs.select(
        F.coalesce(docs[id].cast("long"), F.lit(_LAST_ID)).alias("id"), F.crc32(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("key"),
        docs[text].alias("text"), F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != text] or [F.lit(1).alias("none")]).alias("rest"))
    found = repeated_windows(keyed.select("id", "key", "text"), width)
    runs = found.groupBy("id", "key").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    both = keyed.join(runs, ["id", "key"], "left")
    nested = both.select(F.struct("id", "key", "text", "rest").alias("row"), "runs")
    schema = nested.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept")).schema
    return nested.mapInArrow(_cut(width), schema)


def clean(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated words cut out of the text; a text that loses none stays as it is, white space included."""
    cut = cut_repeats(docs, id=id, text=text, width=width)
    new = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")).alias(text)
    return cut.select(*[new if c == text else F.col(f"row.rest.`{c}`").alias(c) for c in docs.columns])


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
l AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
v AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM l),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
k AS (SELECT p.doc_id, count(*) AS n_words, count(v.i) AS n_removed,
  string_agg(p.word, ' ' ORDER BY p.i) FILTER (v.i IS NULL) AS kept FROM p LEFT JOIN v ON p.doc_id = v.doc_id AND p.i = v.i GROUP BY p.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""


@query("op10_substring_dedup", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, windows of 20 words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_repeats(docs).select("row.rest.doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
