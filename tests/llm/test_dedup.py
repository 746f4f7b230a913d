"""Near duplicates, repeated passages, benchmark passages and components against brute force."""

import random
import tracemalloc

import helpers
import numpy as np
import pyarrow as pa
import pytest
from linkcat.llm import components, minhash, superkmer, wu_manber
from linkcat.llm import text as tx

SCHEMA = "doc_id long, text string, n long, kept string"


def corpus(seed=1):
    """Random documents with copies, near copies, shared passages, odd ids and odd texts."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "été", "straße", "x1"] + ["w" + str(i) for i in range(300)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, passage = words(120), words(45)
    rows = [None, "", " \t\n", "one", "ONE", "one two three", "One  two\tthree", "one two three four", "\x00 nul", "é", "line\nbreak   wide"]
    for k in range(60):
        text = words(rng.randint(1, 150))
        if k % 3 == 0:
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
                text[rng.randrange(len(text))] = "z" + str(rng.randrange(1000))
        if k % 4 == 0:
            at = rng.randrange(len(text))
            text[at:at] = passage[rng.randrange(10) :]
        if k % 5 == 0:
            text += text[-40:]
        rows.append(" ".join(w.upper() if rng.random() < 0.05 else w for w in text))
    rows.append(" ".join(words(20_000)))
    rng.shuffle(rows)
    docs = [(i, t) for i, t in enumerate(rows)]
    docs += [docs[5], docs[9], (None, rows[5]), (None, rows[9])]
    return docs


@pytest.fixture(scope="module")
def docs():
    return corpus()


def frame(spark, docs):
    return spark.createDataFrame([(d, t, 7, "x") for d, t in docs], SCHEMA).repartition(5)


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(spark, docs, width):
    got = minhash.near_duplicates(frame(spark, docs), width=width).collect()
    want = helpers.near_duplicates(docs, width)
    assert sorted(map(str, [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got])) == sorted(
        str((d, n, c, c is None or c == d)) for d, n, c in want)
    assert any(c not in (None, d) for d, _, c in want)


def test_keep_first_returns_the_rows_as_they_were(spark, docs):
    kept = minhash.keep_first(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "n", "kept"]
    want = [(d, t) for (d, t), (_, _, c) in zip(docs, helpers.near_duplicates(docs), strict=True) if c is None or c == d]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, want))


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    rows = []
    for i in range(400):
        text = list(base)
        for _ in range(rng.randrange(1, 6)):
            text[rng.randrange(len(text))] = f"z{rng.randrange(10_000)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(f"u{rng.randrange(900)}" for _ in range(50))) for i in range(100)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for d, _, c in helpers.near_duplicates(rows)}


def test_members_of_a_bucket_that_are_not_similar_are_not_paired(spark, monkeypatch):
    """Most of a group have half a text in common and are similar to few others, which are found all the same."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(250):
        own = [f"z{i // 2}x{k}" for k in range(rng.choice([30, 40, 60]))]
        rows.append((i, " ".join(base + own[: len(own) - i % 2 * 3])))
    asked, open_pairs = [], minhash._open_pairs
    monkeypatch.setattr(minhash, "_open_pairs", lambda *a: (asked.append(open_pairs(*a)), asked[-1])[1])
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=60, rows=2).collect()}
    assert got == {d: c for d, _, c in helpers.near_duplicates(rows)} and len(set(got.values())) > 50
    assert sum(p.count() for p in asked) < 10 * len(rows)


def test_near_copies_of_every_degree_are_linked_as_by_brute_force(spark):
    """Copies with 1 to 40 changed words, so that similarities lie on both sides of the limit."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(60)}" for _ in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randrange(1, 40)):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(3)] = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(3))]
        rows.append((i, " ".join(text)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for d, _, c in helpers.near_duplicates(rows)} and len(set(got.values())) > 20


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 205), (205, 203), (301, 300)]
    rng = random.Random(2)
    rng.shuffle(links)
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {205: 200, 203: 200, 301: 300}


@pytest.mark.parametrize("width", [20, 6])
def test_repeated_passages(spark, docs, width):
    got = superkmer.cut_repeats(frame(spark, docs), width=width).select("row.rest.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, helpers.cut_repeats(docs, width)))
    assert sum(r["n_removed"] for r in got) > 500


def test_frequent_minimisers_change_nothing(spark, docs, monkeypatch):
    monkeypatch.setattr(superkmer, "FREQUENT", 1)
    got = superkmer.cut_repeats(frame(spark, docs)).select("row.rest.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, helpers.cut_repeats(docs)))


def test_a_bucket_keeps_little_of_its_payloads():
    """The words of one payload are in memory at a time, and nothing of a bucket's size stays in a worker."""
    rng = np.random.default_rng(0)
    work, rows = superkmer._pack(20, 1, np.zeros(0, np.uint64)), []
    for part in range(16):
        ids = np.arange(150) + 150 * part
        data, offsets = tx.buffers(pa.array([" ".join(map(str, rng.integers(0, 10**6, 500))) for _ in ids]))
        rows += [payload for _, payload in work(ids, ids, data, offsets)]
    table = pa.table({"payload": pa.array(rows, pa.binary())})
    tracemalloc.start()
    found = superkmer._bucket(20)((), table)
    left, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found.num_rows == 0 and peak < 160 << 20 and left < 8 << 20


def test_clean_leaves_texts_without_repeats(spark, docs):
    cut = superkmer.clean(frame(spark, docs))
    assert cut.columns == ["doc_id", "text", "n", "kept"]
    want = [(d, kept if gone else t) for (d, t), (_, _, gone, kept) in zip(docs, helpers.cut_repeats(docs), strict=True)]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in cut.collect()))) == sorted(map(str, want))


ITEMS = [("b", "one two three four five six seven eight nine ten eleven twelve"), ("a", "Short, item!"), ("c", "ONE two three four five six seven eight nine ten"),
         ("a", "short item"), ("d", None), ("e", " .,"), (None, "nameless"), ("f", "été")]


def hits():
    return [(1, "x one two three four five six seven eight nine ten y"), (2, "ONE, two; three four five six seven eight nine ten ELEVEN twelve one"), (3, "one two three four five six seven eight nine"),
            (4, "a short.item and short item short"), (5, None), (6, ""), (7, "nameless"), (8, "Été été"), (8, "Été été"), (None, "short item"),
            (9, "pad " * 3000 + "one two three four five six seven eight nine ten eleven " * 3)]


def test_contamination(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = wu_manber.search(frame(spark, hits()), items).select("row.doc_id", "n", "hit", "found").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, helpers.contaminated(hits(), ITEMS)))


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(wu_manber, "BLOCK_BYTES", 100)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = wu_manber.search(frame(spark, hits()), items).select("row.doc_id", "n", "hit", "found").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, helpers.contaminated(hits(), ITEMS)))


def test_random_patterns(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    docs, items = [(i, text(rng.randrange(200))) for i in range(40)], [(str(i), text(rng.randrange(14))) for i in range(30)]
    got = wu_manber.search(frame(spark, docs), spark.createDataFrame(items, "item_id string, text string")).select("row.doc_id", "n", "hit", "found").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, helpers.contaminated(docs, items)))


def test_clean_keeps_columns(spark):
    kept = wu_manber.clean(frame(spark, hits()), spark.createDataFrame(ITEMS, "item_id string, text string"))
    assert kept.columns == ["doc_id", "text", "n", "kept"] and sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 6]


def test_empty_tables(spark):
    empty, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id string, text string")
    assert minhash.near_duplicates(empty).count() == 0 and superkmer.cut_repeats(empty).count() == 0 and wu_manber.search(empty, items).count() == 0
    assert [tuple(r) for r in wu_manber.search(frame(spark, [(1, "a b")]), items).select("n", "hit", "found").collect()] == [(2, [], [])]
