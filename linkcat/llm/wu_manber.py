"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of benchmark words. Patterns of one length make one searcher: blocks of up to ``BLOCK`` words
index a shift table that says how far the search may jump without missing a pattern; where it says 0, the block's hash
selects the bucket of the test strings that end in it, and direct comparison of the words, then of the bytes, confirms an
occurrence. All texts of a slice are searched together: each text (long ones in lanes) has a cursor, and the cursors
jump side by side in numpy.

The benchmark is a stated query set. It is taken in blocks of at most ``BLOCK_BYTES`` of text, each of which goes to
the tasks once; documents pass all blocks in turn and carry what was found so far, so neither a block nor a row grows
with the number of blocks beyond the hits themselves.

Defined results: null and empty texts have no words and no hits; null or empty benchmark texts have no window; items
that repeat an id count once; an item with a null id is searched and its hits count, but it is no item of the list; an
empty benchmark hits nothing; rows stay as they are, repeated ones included; columns of any name are kept, because the
operator works beside the row.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table
from linkcat.session import durable

WIDTH = 10
BLOCK = 3
BLOCK_BYTES = 16 << 20
#: Cursor steps over one lane at most cover so many window ends.
LANE = 512
_C = np.uint64(0x9E3779B97F4A7C15)


def _blocks(hashes: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words up to and with ``end``."""
    out = hashes[end]
    for k in range(1, size):
        out = (out * _C) ^ hashes[end - k]
    return tx.mix(out)


class Searcher:
    """Wu-Manber tables for patterns of ``m`` words, given as word hashes and as bytes (words joined by a space)."""

    def __init__(self, patterns: np.ndarray, texts: list[bytes]):
        self.words, self.texts = patterns, texts
        count, self.m = patterns.shape
        self.size = min(BLOCK, self.m)
        self.jump = self.m - self.size + 1
        bits = max(12, int(np.ceil(np.log2(count * self.jump * 8))))
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.jump, np.int16)
        flat = patterns.ravel()
        for last in range(self.size - 1, self.m):
            block = _blocks(flat, np.arange(count) * self.m + last, self.size)
            at = (block >> self.down).astype(np.int64)
            np.minimum.at(self.shift, at, self.m - 1 - last)
        order = np.argsort(block, kind="stable")
        self.suffix, self.order = block[order], order

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Ends of the windows that no shift rules out."""
        n = np.maximum(np.diff(first) - self.m + 1, 0)
        lanes = -(-n // LANE)
        of = np.repeat(np.arange(len(n)), lanes)
        part = np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        cursor = first[of] + self.m - 1 + part * LANE
        limit = np.minimum(cursor + LANE, first[of] + self.m - 1 + n[of])
        found = []
        while len(cursor):
            step = self.shift[(_blocks(hashes, cursor, self.size) >> self.down).astype(np.int64)]
            hit = step == 0
            if hit.any():
                found.append(cursor[hit])
            cursor = cursor + np.maximum(step, 1)
            on = cursor < limit
            if not on.all():
                cursor, limit = cursor[on], limit[on]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray, words: tx.Words) -> tuple[np.ndarray, np.ndarray]:
        """End word and pattern of every occurrence."""
        end = self.candidates(hashes, words.first)
        block = _blocks(hashes, end, self.size)
        low, high = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        n = high - low
        end, at = np.repeat(end, n), np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pattern = self.order[at]
        for k in range(self.m):  # word by word, from the first; few candidates outlive it
            same = hashes[end - self.m + 1 + k] == self.words[pattern, k]
            end, pattern = end[same], pattern[same]
        equal = np.zeros(len(end), bool)
        view, begin, stop = words.data, words.start, words.end
        for i, (e, p) in enumerate(zip(end.tolist(), pattern.tolist(), strict=True)):
            text = self.texts[p]
            raw = view[begin[e - self.m + 1] : stop[e]].tobytes()
            equal[i] = raw == text or b" ".join([view[begin[j] : stop[j]].tobytes() for j in range(e - self.m + 1, e + 1)]) == text
        return end[equal], pattern[equal]


class Block:
    """Searchers for a block of items, by pattern length, with the items of each pattern."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], width: int):
        known: dict[int, dict[bytes, tuple[np.ndarray, set]]] = {}
        for item, text in items:
            data = tx.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            words = tx.Words(data, np.array([0, len(data)]), tx.LETTERS)
            m = min(width, len(words))
            if not m:
                continue
            hashes, joined = words.hashes(), [data[a:b].tobytes() for a, b in zip(words.start, words.end, strict=True)]
            for i in range(len(words) - m + 1):
                entry = known.setdefault(m, {}).setdefault(b" ".join(joined[i : i + m]), (hashes[i : i + m], set()))
                if item is not None:
                    entry[1].add(item)
        self.searchers = [Searcher(np.stack([h for h, _ in x.values()]), list(x)) for x in known.values()]
        self.items = [[sorted(ids) for _, ids in x.values()] for x in known.values()]


def _search(block: Block):
    """Word spans and items found in each text, added to those of earlier blocks."""
    def work(texts: pa.Array) -> dict[str, pa.Array]:
        data, offsets = tx.buffers(texts)
        words = tx.Words(tx.LOWER[data], offsets, tx.LETTERS)
        hashes, of = words.hashes(), words.text
        cover = np.zeros(len(words) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for searcher, names in zip(block.searchers, block.items, strict=True):
            end, pattern = searcher.find(hashes, words)
            np.add.at(cover, end - searcher.m + 1, 1)
            np.add.at(cover, end + 1, -1)
            for row, p in set(zip(of[end].tolist(), pattern.tolist(), strict=True)):
                items.setdefault(row, set()).update(names[p])
        hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        place = hit - words.first[of[hit]] if len(hit) else hit
        cut = np.searchsorted(hit, words.first)
        n = len(offsets) - 1
        lists = [sorted(items.get(i, ())) for i in range(n)] if items else [[]] * n
        return {"n": pa.array(words.counts, pa.int64()), "hit": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(place, pa.int32())),
                "found": pa.array(lists, pa.list_(pa.string()))}

    return lambda: work


def blocks(items: DataFrame, id: str, text: str, width: int) -> Iterable[Block]:
    """The items in blocks of bounded size, fetched one partition at a time."""
    part, size = [], 0
    for row in items.select(items[id].cast("string").alias("id"), items[text].alias("text")).toLocalIterator():
        part.append((row["id"], row["text"]))
        size += len(row["text"] or "") + 64
        if size >= BLOCK_BYTES:
            yield Block(part, width)
            part, size = [], 0
    if part:
        yield Block(part, width)


def search(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """Each row of ``docs`` as the struct ``row`` with ``n`` words, ``hit`` (places of hit words, sorted) and ``found`` (ids of occurring items, sorted)."""
    out = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.lit(None).cast("long").alias("n"),
                      F.array().cast("array<int>").alias("hit"), F.array().cast("array<string>").alias("found"))
    searched = False
    for block in blocks(items, item_id, item_text, width):
        if searched:
            out = durable(out)
        flat = out.select("row", "hit", "found", F.col(f"row.`{text}`").alias("text"))
        here = tx.add_columns(flat, "n long, hit array<int>, found array<string>", _search(block))
        out = here.select("row.row", "n", F.array_sort(F.array_union("row.hit", "hit")).alias("hit"), F.array_sort(F.array_union("row.found", "found")).alias("found")) if searched else here.select("row.row", "n", "hit", "found")
        searched = True
    if not searched:
        flat = out.select("row", F.col(f"row.`{text}`").alias("text"))
        out = tx.add_columns(flat, "n long, hit array<int>, found array<string>", _search(Block([], width))).select("row.row", "n", "hit", "found")
    return out


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no window of any item occurs."""
    found = search(docs, items, **options).where(F.size("hit") == 0)
    return found.select("row.*")


SQL = r"""
WITH a AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents, a),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark, a),
m AS (SELECT item_id, ws, least(10, len(ws)) AS m FROM b WHERE len(ws) > 0),
p AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS win FROM (SELECT item_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM m)),
n AS (SELECT DISTINCT m FROM p),
o AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS win FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, n)),
h AS (SELECT doc_id, o.m, i, item_id FROM o JOIN p ON o.m = p.m AND o.win = p.win),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id),
v AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS i FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN v ON d.doc_id = v.doc_id
"""


@query("op1_wu_manber_decontamination", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, windows of 10 words."""
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = F.size("hit").cast("long")
    return found.select("row.doc_id", F.col("n").alias("n_words"), hits.alias("n_hit"), F.size("found").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found", ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))
