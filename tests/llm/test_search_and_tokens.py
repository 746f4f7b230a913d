"""Nearest neighbours, token counts, SentencePiece, URLs and chats against brute force and the public libraries."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers as public
import pytest
import sentencepiece
from linkcat.llm import chat, posting_lists, sentencepiece_viterbi, token_counts, url_rules
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PIECES, BPE = public.path("piece_bpe_32k.model"), public.path("byte_bpe_50k.json")


def texts(seed=1):
    rng = random.Random(seed)
    alphabet = "aab  ceinorst▁\n.é漢😀 =_-1'’\u0301\u00a0\u200b\t<|>"
    out = [None, "", " ", "\x00", "  two  spaces  ", "don't we'll I'M", "<|endoftext|>a <|endoftext|><|endoftext|> b", "\U000105c0 \U0001fae9 new", "a\u2028b\u0085c  \n\n d", "ﬁ１", "a" * 3000, "x y " * 20_000]
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(400)]
    return out + [public.__doc__ or "", open(public.__file__).read()]


def test_token_counts(spark, monkeypatch):
    rows = [(i, t, 5) for i, t in enumerate(texts())] + [(3, "\x00", 5), (4, "again", 5), (None, "no id", 5), (None, "no id", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    model = Tokenizer.from_file(BPE)
    want = sorted(str((d, len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False).ids))) for d, t, _ in rows)
    for head in (400_000, 5):  # nearly all pre-tokens on either way
        monkeypatch.setattr(token_counts, "HEAD", head)
        got = token_counts.token_counts(docs, BPE).collect()
        assert sorted(str((r["doc_id"], r["n_bytes"], r["n_tokens"])) for r in got) == want
    assert token_counts.token_counts(docs.limit(0), BPE).count() == 0


def test_pieces_are_the_librarys(spark):
    rows = [(i, t, 5) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(docs, PIECES), PIECES).select("row.doc_id", "ids", "decoded").collect()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert {r["doc_id"]: r["ids"] for r in got} == {d: model.encode(t or "") for d, t, _ in rows}
    assert {r["doc_id"]: r["decoded"] for r in got} == {d: (t or "").replace("▁", " ") for d, t, _ in rows}
    both = sentencepiece_viterbi.encode_and_decode(docs, PIECES).select("row.doc_id", "ids", "decoded").collect()
    assert sorted(map(str, both)) == sorted(map(str, got))
    assert sentencepiece_viterbi.encode(docs.limit(0), PIECES).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 16))
    x = (centre[rng.integers(12, size=1500)] + 0.6 * rng.normal(size=(1500, 16))).astype(np.float32)
    x *= rng.uniform(0.5, 2, size=(1500, 1)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)] + [(1500, None, "a"), (1520, [0.0] * 16, "a"), (1540, [float("nan")] + [1.0] * 15, "a"), (1560, [None] + [1.0] * 15, "a"), (1580, [], "a"), (1600, [1.0], "a"), (None, x[3].tolist(), "a"), (20, x[20].tolist(), "b")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(4)
    got = posting_lists.nearest_neighbours(vectors, "vec_id % 20 = 0").collect()
    wide = x.astype(np.float64)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 1500, 20))
    right = 0
    for q, hits in found.items():
        hits.sort()
        s = wide @ wide[q]
        order = [i for i in np.lexsort((np.arange(1500), -np.round(s, 9))) if i != q][:20]
        assert [h[0] for h in hits] == list(range(1, 21)) and q not in [h[1] for h in hits]
        assert all(abs(s[i] - v) < 1e-9 for _, i, v in hits) and [h[1:] for h in hits] == sorted((h[1:] for h in hits), key=lambda h: (-h[1], h[0]))
        right += len(set(order) & {h[1] for h in hits})
    assert right / (20 * len(found)) >= 0.9
    short = spark.createDataFrame([(-40 + i, [float(i % 7 + 1), 1.0], "c") for i in range(40)], vectors.schema)
    two = posting_lists.nearest_neighbours(vectors.unionByName(short), "vec_id % 20 = 0").collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in two if r["query_id"] >= 0} == {(r["query_id"], r["rank"], r["vec_id"]) for r in got}
    value = lambda i, j: float(((i + 40) % 7 + 1) * ((j + 40) % 7 + 1) + 1)
    for c in (-40, -20):
        want = sorted((j for j in range(-40, 0) if j != c), key=lambda j: (-value(c, j), j))[:20]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in two if r["query_id"] == c), key=lambda r: r["rank"])] == [(j, value(c, j)) for j in want]
    few = posting_lists.nearest_neighbours(vectors.where("vec_id < 15 or vec_id = 20"), "vec_id % 20 = 0")
    assert {(r["query_id"], r["n"]) for r in few.groupBy("query_id").agg(F.count("*").alias("n")).collect()} == {(0, 15), (20, 15)}
    assert posting_lists.nearest_neighbours(vectors.limit(0), "vec_id % 20 = 0").count() == 0


def test_neighbours_in_many_lists_without_clusters(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "LIST_SIZE", 16)
    x = np.random.default_rng(4).normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = posting_lists._graph(x, 375, 1.0)
    assert len(graph.centre) > 300 and len(graph.lists_of(x)[0]) > 1.2 * len(x)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = posting_lists.nearest_neighbours(vectors, "vec_id % 60 = 0").collect()
    right = sum(r["vec_id"] in np.argsort(-np.where(np.arange(6000) == r["query_id"], -9, x @ x[r["query_id"]]))[:20] for r in got)
    assert len(got) == 2000 and right / 2000 >= 0.97


def test_a_workers_memory_does_not_grow_with_the_lists(monkeypatch):
    """What is placed comes in batches of bounded size, however many lists a row is in."""
    rng = np.random.default_rng(3)
    graph = posting_lists.Graph.build(rng.normal(size=(600, 9)).astype(np.float32), 1.0)
    graph.slots = np.ones(600, np.int32)
    x = rng.normal(size=(300, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(list(x))], ["key", "v"])
    monkeypatch.setattr(posting_lists, "PLACED", 64 * 8 * 8, raising=False)
    placed = list(posting_lists._place(SimpleNamespace(value=graph), "other_lists_for")([batch]))
    assert max(b.num_rows for b in placed) <= 64
    row, lists = graph.other_lists_for(x)
    assert sorted((k, i) for b in placed for k, i in zip(b["key"].to_pylist(), b["list"].to_pylist())) == sorted(zip(row.tolist(), lists.tolist()))


def test_queries_of_a_list_are_dealt_into_slots(spark, monkeypatch):
    """A list that many queries read is searched by some of them at a time, with the same result."""
    rng = np.random.default_rng(6)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 6)))], "vec_id long, embedding array<double>").repartition(4)
    whole = sorted(map(tuple, posting_lists.nearest_neighbours(vectors, "vec_id % 5 = 0").collect()))
    sizes = spark.sparkContext.accumulator(0)
    search = posting_lists._nearest_in_list

    def counted(k):
        run = search(k)

        def one(key, left, right):
            sizes.add(left.num_rows > 300)
            return run(key, left, right)

        return one

    monkeypatch.setattr(posting_lists, "_nearest_in_list", counted)
    monkeypatch.setattr(posting_lists, "ASKED", 100 * 6 * 8, raising=False)
    assert sorted(map(tuple, posting_lists.nearest_neighbours(vectors, "vec_id % 5 = 0").collect())) == whole and sizes.value == 0



def test_graph_search_finds_near_centroids():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20_000, 32))
    graph = posting_lists._graph(x[:8000], 800, float(np.linalg.norm(x, axis=1).max()))
    q = graph.embed(x[9000:9200], True)
    ids, _ = graph.nearest(q, 8)
    best = np.argsort(posting_lists._distances(q, graph.centre), 1)[:, :8]
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(ids, best, strict=True)]) > 0.9
    far = np.sqrt(posting_lists._distances(q, graph.centre))
    far /= np.maximum(far.min(1, keepdims=True), posting_lists.FLOOR)
    for probe in (1.05, 1.3, float("inf")):
        row, centre, ratio = graph.reach(x[9000:9200], probe)
        inside = far <= probe
        walked = np.zeros_like(inside)
        walked[row, centre] = True
        assert (walked & inside).sum() / inside.sum() > 0.97 and np.bincount(row, minlength=200).min() >= 8
        assert np.allclose(ratio, far[row, centre], rtol=0.2) and (walked & ~inside).sum() <= 8 * 200


def test_urls(spark):
    urls = ["http://A.Example.ORG/es/1", "https://example.org/en/15?x#y", "https://notexample.org/en/1", "http://x.com/fr/", "http://x.com/de/casino-bonus", "http://x.net/adult/sex", "http://x.net/adult/adult",
            "http://x.net/adultsex", "ftp://x.net/xxx", "xxx.net/xxx", None, "", "http://com", "http://org", "http://free-XXX.net#frag://", "a://b://c/d", "http://x.net/ésex/bet", "http://x.net?adult sex"]
    pages = spark.createDataFrame([(i, u, "other") for i, u in enumerate(urls)] + [(3, urls[3], "other")], "page_id long, url string, host string")
    got = url_rules.judge(pages).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(urls) + 1
    by = {r["page_id"]: tuple(r)[1:] for r in got}
    assert by[0] == ("a.example.org", "/es/1", "example.org/es/", "block") and by[1] == ("example.org", "/en/15", "example.org/en/1", "block")
    assert by[2] == ("notexample.org", "/en/1", "org/", "allow") and by[3][2:] == ("com/fr/", "allow") and by[4][2:] == ("com/de/", "block")
    assert by[5][2:] == (None, "block") and by[6][2:] == (None, "allow") and by[7][2:] == (None, "allow") and by[8] == ("x.net", "/xxx", None, "block")
    assert by[9] == by[10] == by[11] == ("", "", None, "allow") and by[12] == ("com", "", None, "allow") and by[13] == ("org", "", None, "allow")
    assert by[14] == ("free-xxx.net", "", None, "block") and by[15] == ("b:", "//c/d", None, "allow") and by[16][3] == "block" and by[17] == ("x.net", "", None, "allow")
    assert url_rules.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in url_rules.judge(pages, rules=(), strict=(), soft=()).collect()} == {"allow"}


def test_chats(spark):
    nasty = ["<|turn|>user<|text|>", "<|", "<<|end|>", "<|raw|>", "<", "|>", "<|next|>x<|", "", None, "plain é😀", "\\E.*\\Q"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<|end|>", None]), rng.choice(nasty)) for c in (1, 2, 3, None) for t in range(40)]
    rows += [(4, 0, "assistant", None), (5, None, "assistant", "a"), (5, 0, "assistant", "b"), (5, 0, "assistant", "b"), (5, 0, "assistant", "a")]
    rows = [(*r, "t") for r in rows]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    chats = chat.format_chats(spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string, formatted string"))
    back = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.read_chats(chats).collect()}
    masked = {r["conv_id"]: r["masked"] for r in chat.masked_text(chats).collect()}
    for c in (1, 2, 3, 4, 5, None):
        want = [(r or "", t or "") for _, _, r, t, _ in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
        assert back[c] == want
        assert masked[c] == "".join(t for r, t in want if r == "assistant")
    text = {r["conv_id"]: r["formatted"] for r in chats.collect()}
    assert text[5] == "<|turn|>assistant<|text|>a<|next|>a<|next|>b<|next|>b<|end|>" and text[4] == "<|turn|>assistant<|text|><|end|>"
    long = spark.range(3 * chat.SLICE + 7).select(F.lit(9).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 5 < 3, "assistant").otherwise("user").alias("role"), F.concat(F.lit("<|"), "id").alias("text"))
    told = chat.format_chats(long)
    n = 3 * chat.SLICE + 7
    assert [tuple(t) for t in chat.read_chats(told).first()["turns"]] == [("assistant" if i % 5 < 3 else "user", f"<|{i}") for i in range(n)]
    assert chat.masked_text(told).first()["masked"] == "".join(f"<|{i}" for i in range(n) if i % 5 < 3)
    assert told.first()["formatted"].count(chat.TURN) == len([i for i in range(n) if i % 5 in (0, 3)])
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_merging_needs_undoing_in_order():
    model = sentencepiece_viterbi.pieces(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(5)
    words = ["".join(rng.choice(["a", "aa", "in", "g", "er", "ing", "th", "the", "=", "==", "1", "▁"]) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    assert [x.tolist() for x in model.encode_all(words)] == library.encode(words)


@pytest.mark.parametrize("bad", ["byte_bpe_50k.json"])
def test_other_files_are_refused(bad):
    with pytest.raises((RuntimeError, ValueError)):
        sentencepiece_viterbi.Pieces(public.path(bad))
