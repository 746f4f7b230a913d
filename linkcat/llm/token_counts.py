"""Token counts of whole texts without token ids: pieces are counted once for each distinct pre-token.

A byte-level BPE splits a text into pre-tokens that never influence each other, so a text's count is the sum, over its
distinct pre-tokens, of their frequency times their number of pieces. Frequencies are kept by document, pieces by
pre-token, and a join brings them together:

* the *head*, the at most ``HEAD`` most frequent pre-tokens of a sample of about ``SAMPLE`` documents, is a table of
  bounded size that goes to all tasks (a map-side join);
* all other pre-tokens go through an equi-join with their distinct list. Only this split depends on the sample, no count does.

Defined results: a null or empty text has 0 bytes and 0 tokens; special tokens' strings inside a text count as the
special token, as the library does by default; every input row gives one row, repeated rows and null ids included; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table
from linkcat.session import durable

HEAD = 400_000
SAMPLE = 40_000
#: Bytes of pre-tokens that are encoded at once, and list entries after which a batch of frequencies is handed on.
ENCODE_BYTES, ENTRIES = 1 << 17, 1 << 16
#: The pre-token rule of the byte-level BPE (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PreTokenizer:
    """Pre-tokens of a text, as a tokenizer file's own library gives them."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.find = regex.compile(PATTERN).findall
        self.safe: set[str] = set()

    def __call__(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens, and the number of special tokens between them."""
        if self.special is None or "<" not in text or not self.special.search(text):
            return self.part(text), 0
        parts = self.special.split(text)
        return [token for part in parts for token in self.part(part)], len(parts) - 1

    def part(self, text: str) -> list[str]:
        if text.isascii() or self.known(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def known(self, text: str) -> bool:
        """Whether Unicode 3.2 assigns all characters; the classes of others depend on the library's own tables."""
        new = set(text) - self.safe
        self.safe.update(c for c in new if unicodedata.ucd_3_2_0.category(c) != "Cn")
        return new <= self.safe

    def pieces(self, tokens: list[str]) -> list[int]:
        """The number of pieces of each pre-token."""
        # One by one: a batch would start threads beside the task's own and keep all encodings until its end.
        encode = self.tokenizer.encode
        return [len(encode(t, add_special_tokens=False).ids) for t in tokens]


@lru_cache(1)
def pre_tokenizer(path: str) -> PreTokenizer:
    """The pre-tokenizer of a file, loaded once in a worker however many tasks it runs."""
    return PreTokenizer(path)


def _texts(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        _, offsets = tx.buffers(batch.column("text"))
        for low, high in tx.slices(offsets):
            part = batch.slice(low, high - low)
            yield part.select(names), [t or "" for t in part.column("text").to_pylist()]


def _sampled(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = pre_tokenizer(path), Counter()
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])
        for _, texts in _texts(batches, []):
            for text in texts:
                seen.update(split(text)[0])
            if len(seen) > 100_000:
                yield out()
                seen = Counter()
        yield out()

    return run


def _counted(path: str):
    """Pieces of distinct pre-tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = pre_tokenizer(path)
        for batch in batches:
            tokens = batch.column(0)
            _, offsets = tx.buffers(tokens)
            for low, high in tx.slices(offsets, ENCODE_BYTES):
                part = tokens.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part, pa.array(split.pieces(part.to_pylist()), pa.int32())], ["token", "pieces"])

    return run


def _keys(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each string."""
    data, at = tx.buffers(tokens)
    wide = data.astype(np.uint64)
    return tuple(tx.run_hashes(wide, at[:-1], at[1:], powers) for powers in (tx._BYTES, tx._SECOND))


class Head:
    """Pieces of frequent pre-tokens by the two hashes of their strings, the first one sorted."""

    def __init__(self, tokens: pa.Array, pieces: np.ndarray):
        first, second = _keys(tokens)
        order = np.argsort(first)
        self.first, self.second, self.pieces = first[order], second[order], pieces[order].astype(np.int32)

    def find(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which strings are frequent, and the pieces of those (0 for others)."""
        if not len(self.first) or not len(tokens):
            return np.zeros(len(tokens), bool), np.zeros(len(tokens), np.int64)
        first, second = _keys(tokens)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        there = (self.first[at] == first) & (self.second[at] == second)
        return there, np.where(there, self.pieces[at], 0).astype(np.int64)


def _frequencies(path: str, head: Callable[[], Head]):
    """Each document with the tokens of its head pre-tokens, and the frequencies of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = pre_tokenizer(path), head()

        def out(part: pa.RecordBatch, total: list[int], tokens: list[str], counts: list[int], ends: list[int]) -> pa.RecordBatch:
            found, n, at = pa.array(tokens, pa.string()), np.array(counts, np.int64), np.array(ends)
            frequent, pieces = known.find(found)
            sums = np.concatenate([[0], np.cumsum(n * pieces)])[at]
            rare = pa.StructArray.from_arrays([found.filter(pa.array(~frequent)), pa.array(n[~frequent], pa.int32())], ["token", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(~frequent)])[at], pa.int32()), rare)
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(np.array(total, np.int64) + np.diff(sums)), lists], ["id", "key", "n_bytes", "base", "rare"])

        for part, texts in _texts(batches, ["id", "key", "n_bytes"]):
            low, total, tokens, counts, ends = 0, [], [], [], [0]
            for i, text in enumerate(texts):
                found, special = split(text)
                seen = Counter(found)
                total.append(special)
                tokens.extend(seen)
                counts.extend(seen.values())
                ends.append(len(tokens))
                if len(tokens) > ENTRIES or i + 1 == len(texts):
                    yield out(part.slice(low, i + 1 - low), total, tokens, counts, ends)
                    low, total, tokens, counts, ends = i + 1, [], [], [], [0]

    return run


def token_counts(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row, for the byte-level BPE file ``path`` (the same on all machines)."""
    spark = docs.sparkSession
    whole = F.coalesce(docs[text], F.lit(""))
    docs = docs.select(docs[id].alias("id"), F.crc32(whole.cast("binary")).alias("key"), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("text"))
    share = max(1, -(-docs.count() // SAMPLE))
    sample = docs.where(F.pmod(F.xxhash64("id", "key"), F.lit(share)) == 0).select("text")
    seen = sample.mapInArrow(_sampled(path), "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n > 1")
    top = seen.orderBy(F.desc("n"), "token").limit(HEAD).select("token")
    few = top.mapInArrow(_counted(path), "token string, pieces int").toArrow()
    tokens = few.column("token").combine_chunks().cast(pa.large_string())
    head = spark.sparkContext.broadcast(Head(tokens, few.column("pieces").to_numpy()))

    kept = durable(docs.mapInArrow(_frequencies(path, lambda: head.value), "id " + docs.schema["id"].dataType.simpleString() + ", key long, n_bytes long, base long, rare array<struct<token string, n int>>"))
    rare = kept.select("id", "key", F.explode("rare").alias("r")).select("id", "key", "r.token", "r.n")
    pieces = rare.select("token").distinct().mapInArrow(_counted(path), "token string, pieces int")
    none = F.lit(None).cast("long")
    tail = rare.join(pieces, "token").groupBy("id", "key").agg(F.sum(F.col("n").cast("long") * F.col("pieces")).alias("tail"))
    rows = kept.select("id", "key", "n_bytes", "base", F.lit(0).cast("long").alias("tail"), F.lit(1).alias("copies")).unionByName(
        tail.select("id", "key", none.alias("n_bytes"), none.alias("base"), "tail", F.lit(0).alias("copies")))
    total = rows.groupBy("id", "key").agg(F.max("n_bytes").alias("n_bytes"), F.max("base").alias("base"), F.sum("tail").alias("tail"), F.sum("copies").alias("copies"))
    each = total.select("id", "n_bytes", (F.col("base") + F.expr("tail div copies")).alias("n_tokens"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return each.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens")


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the byte-level BPE of 50k pieces, with a limit of 512 tokens."""
    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
