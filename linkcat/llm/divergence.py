"""How far the sources of a language differ in their words: every pair of sources, and each source's most telling terms.

Identical texts of a language are collapsed to one with its number of copies in each source, so a text is tokenized once
however often it occurs; its term counts and document frequencies are then weighted by these numbers.

With ``V`` kept terms in a language and ``N`` occurrences of kept terms in a group (a source of the language, or the whole
language), a term of ``count`` occurrences has the smoothed share ``1 + floor(SCALE * (count + 2) / (N + 2 V))``. Two
shares differ by ``f(p, q) = floor((p - q)^2 / (p + q))``; a pair of sources differs by the sum of ``f`` over all kept terms.

That sum is evaluated sparsely. A term that one source lacks adds ``f`` of a count and a constant, so a histogram of counts
gives all such terms at once; only terms that both sources hold are paired, and correct what the histograms assumed.

Defined results: null text, lang or source is the empty string; an empty text has no terms; repeated rows all count;
terms of equal value rank by their UTF-8 bytes; a language without kept terms has pairs of value 0 and no term rows; an empty
table gives an empty result; other columns are not read. The list of a term's sources is one value, and a text must fit
into a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table
from linkcat.llm.scan import bounded
from linkcat.session import durable

SCALE = 1_000_000_000
#: Rows of counts that a task adds up before it hands them on.
MERGE_ROWS = 800_000
#: Letters (after lower-casing) and everything beyond ASCII.
TERMS = ((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)) | (np.arange(256) >= 0x80)


def difference(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / (p + q)) of whole numbers up to 1,000,000,001, without rounding."""
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 kept)), without rounding."""
    over = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, (total + 2 * kept).cast("decimal(20,0)")) + 1


def collapse(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Each different text of a language once: ``lang``, ``text``, and ``copies`` (array of source and number of rows)."""
    none = F.lit("")
    rows = docs.select(F.coalesce(docs[lang], none).alias("lang"), F.coalesce(docs[source], none).alias("source"), F.coalesce(docs[text], none).alias("text"))
    rows = rows.where("text <> ''").select("*", F.xxhash64(F.lit(1), "text").alias("k1"), F.xxhash64(F.lit(2), "text").alias("k2"))
    counted = rows.groupBy("lang", "k1", "k2", "source").agg(F.count("*").alias("n"))
    copies = counted.groupBy("lang", "k1", "k2").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "k1", "k2").agg(F.any_value("text").alias("text"))
    return texts.join(copies, ["lang", "k1", "k2"]).select("lang", "text", "copies")


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    at = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(start - at[:-1], size) + np.arange(at[-1])
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data[where])])


def _runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted counts of terms, added up over the slices of a task until their table grows too large."""
    held, rows = [], 0
    for batch in _slice_counts(batches):
        held.append(batch)
        rows += batch.num_rows
        if rows > MERGE_ROWS:
            merged = _merged(held)
            held, rows = [merged], merged.num_rows
            if rows > MERGE_ROWS // 2:
                yield merged
                held, rows = [], 0
    if held:
        yield _merged(held)


def _merged(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    whole = pa.Table.from_batches(batches).group_by(["lang", "source", "term"]).aggregate([("count", "sum"), ("docs", "sum")])
    return whole.rename_columns(["lang", "source", "term", "count", "docs"]).combine_chunks().to_batches()[0]


def _slice_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted counts of terms: of the copies in each source, summed over the texts of a slice."""
    for batch in batches:
        langs, texts, copies = (batch.column(i) for i in range(3))
        _, offsets = tx.buffers(texts)
        for low, high in tx.slices(offsets):
            data, at = tx.buffers(texts.slice(low, high - low))
            words = tx.Words(tx.LOWER[data], at, TERMS)
            if not len(words):
                continue
            hashes, of = words.hashes(), words.text
            order = np.lexsort((of, hashes))
            begin = _runs(hashes[order], of[order])
            first = order[begin]
            times = np.diff(np.append(begin, len(order)))
            term = np.cumsum(np.concatenate([[True], hashes[first][1:] != hashes[first][:-1]])) - 1
            # The copies of each text: from row ``held[i]`` of the flattened list on.
            here = copies.slice(low, high - low)
            number = np.asarray(here.value_lengths())
            held = np.cumsum(number) - number
            flat = here.flatten()
            names = flat.field("source").dictionary_encode()
            lang = langs.slice(low, high - low).dictionary_encode()
            group = np.repeat(np.asarray(lang.indices), number) * len(names.dictionary) + np.asarray(names.indices)
            rows = np.asarray(flat.field("n"))
            text = of[first]
            each = number[text]
            entry = np.repeat(held[text] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            key = np.repeat(term, each) * (len(names.dictionary) * len(lang.dictionary)) + group[entry]
            count, docs = np.repeat(times, each) * rows[entry], rows[entry]
            order = np.argsort(key, kind="stable")
            key = key[order]
            begin = _runs(key)
            count, docs = np.add.reduceat(count[order], begin), np.add.reduceat(docs[order], begin)
            term_of, group = np.divmod(key[begin], len(names.dictionary) * len(lang.dictionary))
            lead = first[_runs(hashes[first])]
            terms = _strings(words.data, words.start[lead], words.end[lead])
            yield pa.RecordBatch.from_arrays([
                lang.dictionary.take(pa.array(group // len(names.dictionary))), names.dictionary.take(pa.array(group % len(names.dictionary))),
                terms.take(pa.array(term_of)), pa.array(count), pa.array(docs)], ["lang", "source", "term", "count", "docs"])


def kept_terms(docs: DataFrame, *, least: int = 10, **columns) -> DataFrame:
    """The terms in ``least`` documents of a language or more: ``lang``, ``term``, ``count``, ``held`` (array of source and count)."""
    found = collapse(docs, **columns).mapInArrow(_counted, "lang string, source string, term string, count long, docs long")
    # Tasks have added up what they can, so one exchange serves both groupings.
    found = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    return found.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("count"), F.collect_list(F.struct("source", "count")).alias("held"),
    ).where(F.col("docs") >= least).select("lang", "term", "count", "held")


def divergence(docs: DataFrame, *, least: int = 10, top: int = 10, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: all pairs of a language's sources, and each source's ``top`` terms."""
    kept = durable(kept_terms(docs, least=least, text=text, lang=lang, source=source))
    entries = kept.select("lang", "term", F.col("count").alias("all"), F.explode("held").alias("h")).select("lang", "term", "all", "h.*")
    langs = kept.groupBy("lang").agg(F.count("*").alias("V"), F.sum("count").alias("N_all"))
    none = F.lit("")
    occurring = docs.select(F.coalesce(docs[lang], none).alias("lang"), F.coalesce(docs[source], none).alias("source")).distinct()
    sizes = entries.groupBy("lang", "source").agg(F.sum("count").alias("N"), F.count("*").alias("held"))
    groups = occurring.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["N", "held", "V", "N_all"])
    groups = durable(groups.withColumn("p0", F.when(F.col("V") > 0, share(F.lit(0), F.col("N"), F.col("V")))))
    n = groups.count()
    known = bounded(groups.select("lang", "source", "N", "N_all", "V", "p0"), n)
    shares = entries.join(known, ["lang", "source"]).select(
        "lang", "source", "term", "p0", share(F.col("count"), F.col("N"), F.col("V")).alias("p"), share(F.col("all"), F.col("N_all"), F.col("V")).alias("q"))
    shares = durable(shares)
    telling = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference("p", "q").alias("value"))
    pairs = _pairs(shares, groups, n).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    first = telling.withColumn("rank", place).where(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(first)


def _pairs(shares: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """``lang``, ``source``, ``item`` (the other source) and the summed difference, both ways round."""
    a = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), F.col("held").alias("a_held"), "V")
    b = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"), F.col("held").alias("b_held"))
    both = a.join(bounded(b, n), "lang")
    zero = difference("a0", "b0")
    base = both.where("a < b").select("lang", "a", "b", ((F.col("V") - F.col("a_held") - F.col("b_held")) * zero).alias("value"))
    # Terms of one source against the other's constant, once for each different share.
    alike = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("k")).withColumnRenamed("source", "a")
    others = bounded(b.select("lang", "b", "b0"), n)
    alone = alike.join(others, "lang").where("a <> b").select(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("k") * difference("p", "b0")).alias("value"))
    left, right = (shares.select("lang", "term", F.col("source").alias(s), F.col("p").alias(f"{s}p"), F.col("p0").alias(f"{s}0")) for s in "ab")
    met = left.join(right, ["lang", "term"]).where("a < b").select(
        "lang", "a", "b", (difference("ap", "bp") - difference("ap", "b0") - difference("a0", "bp") + zero).alias("value"))
    parts = [df.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")) for df in (base, alone, met)]
    total = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "a", "b").agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value"))
    total = durable(total)
    return total.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        total.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))


#: All kept terms of all pairs, without histograms or sparse sums.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(t.n, 0)::HUGEINT AS n, k.n::HUGEINT AS n_all FROM g JOIN k USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
s AS (SELECT *, (1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)))::BIGINT AS p,
  (1 + (1000000000 * (n_all + 2)) // (sum(n_all) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)))::BIGINT AS q FROM c),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
"""


@query("op11_source_divergence", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: sources by language, terms in 10 documents or more."""
    return divergence(table(spark, sf_dir, "documents"))
