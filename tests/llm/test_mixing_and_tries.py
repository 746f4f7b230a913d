"""Source divergence, curriculum mixing, prefix tries, running sums and list ranking against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import helpers
import pytest
from linkcat.llm import curriculum, divergence, prefix_trie, scan
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


# -- running sums and list ranking -----------------------------------------------------------------------------------


def test_running_values_cross_partitions(spark):
    rng = random.Random(1)
    rows = [(0 if i < 300 else rng.randrange(5), i, rng.randrange(-50, 50)) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["i"]: (r["v_upto"], r["w_upto"], r["v_before"]) for r in scan.running(df.withColumn("w", F.col("v")), "k", ["i"], sums=["v"], xors=["w"], lags=["v"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total, mixed, before = Counter(), Counter(), {}
    for k, i, v in sorted(rows):
        total[k] += v
        mixed[k] ^= v
        assert got[i] == (total[k], mixed[k], before.get(k))
        before[k] = v


def test_running_of_nothing(spark):
    assert scan.running(spark.createDataFrame([], "k long, v long"), None, ["k"], sums=["v"]).count() == 0


@pytest.mark.parametrize("n,last", [(1, 4), (5, 4), (700, 40)])
def test_list_ranks(spark, monkeypatch, n, last):
    monkeypatch.setattr(scan, "RUN", 30)
    ids = list(range(100, 100 + n))
    random.Random(n).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, [*ids[1:], None], strict=True)), "id long, next long").repartition(4)
    assert {r["id"]: r["place"] for r in scan.list_ranks(links, last).collect()} == {i: p for p, i in enumerate(ids)}


# -- source divergence -----------------------------------------------------------------------------------------------


def diverging(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [(lang, source, TERM.findall(text.translate(helpers.LOWER))) for text, lang, source in rows]
    out = []
    for lang in {w[0] for w in words}:
        here = [(s, ws) for k, s, ws in words if k == lang]
        in_docs = Counter(t for _, ws in here for t in set(ws))
        kept = sorted(t for t, n in in_docs.items() if n >= least)
        counts = defaultdict(Counter)
        for s, ws in here:
            counts[s].update(t for t in ws if in_docs[t] >= least)
        whole = sum(counts.values(), Counter())
        v = len(kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept}  # noqa: E731, B023
        f = lambda p, q: (p - q) ** 2 // (p + q)
        shares, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(o, sum(f(p[t], r[t]) for t in kept)) for o, r in shares.items() if o != s]
            terms = [(t, f(p[t], q[t])) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for i, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]):
                    out.append((lang, s, part, item, value, i + 1))
    return sorted(out)


def sources(seed=2):
    rng = random.Random(seed)
    words = ["the", "Of", "été", "a1b", "straße", "x", "日本"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(None, "en", "s0"), ("", "en", "empty"), ("123 456", "en", None), (None, None, None), ("only", "zz", "a"), ("only", "zz", "b"), ("word " * 3000, "en", "s1")]
    for _ in range(150):
        rows.append((" ".join(rng.choice(words) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", None])))
    return rows + [rows[10]] * 30 + [rows[11]] * 5


def test_divergence(spark):
    rows = sources()
    df = spark.createDataFrame([(i % 7, *r, "clash", "x") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, value string").repartition(5)
    got = [tuple(r) for r in divergence.divergence(df, least=5, top=4).collect()]
    want = diverging(rows, 5, 4)
    assert sorted(got) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[4] == 0 for r in want)


def test_divergence_of_copies_tokenizes_each_text_once(spark):
    df = spark.createDataFrame([("same text", "en", f"s{i % 3}") for i in range(90)] + [("same text", "de", "s0"), ("other", "en", "s0")], "text string, lang string, source string")
    got = {(r["lang"], r["text"]): sorted(map(tuple, r["copies"])) for r in divergence.collapse(df).collect()}
    assert got == {("en", "same text"): [("s0", 30), ("s1", 30), ("s2", 30)], ("de", "same text"): [("s0", 1)], ("en", "other"): [("s0", 1)]}


def test_divergence_of_nothing(spark):
    assert divergence.divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


# -- curriculum ------------------------------------------------------------------------------------------------------


def filled(sizes, weights, share=1.5, most=2):
    """Targets by resharing the excess until none is above."""
    target = dict.fromkeys(sizes, 0.0)
    rest, open_ = share * sum(sizes.values()), {s for s in sizes if weights[s] > 0}
    while open_ and rest > 1e-9:
        unit = rest / sum(weights[s] for s in open_)
        rest = 0.0
        for s in list(open_):
            target[s] += unit * weights[s]
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.remove(s)
    return target


def mixable():
    rng = random.Random(4)
    rows = [(None, None, "a"), (1, "", "a"), (None, "no id here", "b"), (7, "twice over", "a"), (7, "twice over", "a"), (7, "twice", "a"), (9, "word " * 20_000, "c"), (3, " \t\n", "empty")]
    rows += [(100 + i, "w " * rng.randrange(1, 60), rng.choice(["a", "a", "a", "b", "d", "e", None])) for i in range(200)]
    return rows


def test_curriculum(spark):
    rows = mixable()
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, source string, size long, target string").repartition(6)
    run = lambda: curriculum.curriculum(df, curriculum.repeating(*curriculum.SCHEDULE))
    got = run().collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(helpers.NOT_SPACE.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 2 * r["size"] and sum(x["tokens"] for x in r["readings"]) == r["taken"]
        assert all(0 <= x["time"] <= 1 and x["tokens"] > 0 for x in r["readings"])
        assert [x["time"] for x in r["readings"]] == sorted(x["time"] for x in r["readings"])
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(want[s] + 1e-6) for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, run().collect()))


def test_readings_follow_the_schedule(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    mixed = curriculum.curriculum(docs, curriculum.repeating(*curriculum.SCHEDULE), share=0.6)
    ordered = curriculum.training_order(mixed).collect()
    assert [r["time"] for r in ordered] == sorted(r["time"] for r in ordered)
    for s, expected in (("s0", (6 / 10)), ("s1", 1 / 2), ("s2", 0.3125)):
        own = [r for r in ordered if r["source"] == s]
        assert sum(r["tokens"] for r in own if r["time"] < 0.5) / sum(r["tokens"] for r in own) == pytest.approx(expected, abs=0.01)


def test_curriculum_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert curriculum.curriculum(spark.createDataFrame([], schema), curriculum.repeating(*curriculum.SCHEDULE)).count() == 0
    blank = curriculum.curriculum(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema), curriculum.repeating(*curriculum.SCHEDULE)).collect()
    assert [(r["target"], r["taken"]) for r in blank] == [(0.0, 0), (0.0, 0)]


# -- prefix trie -----------------------------------------------------------------------------------------------------


def told(turns):
    chats = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            chats[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(r, x) for _, _, r, _, x in sorted(ts)] for c, ts in chats.items()}


def shared(turns):
    chats = told(turns)
    made = {}
    for c in chats:
        leader = c - (c % 20 if c >= 0 else -(-c % 20))
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = chats[c] if c == leader else chats.get(leader, [])[:h] + chats[c][h:]
    members = defaultdict(list)
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    own = {k: (len(m) - 1) * (len(helpers.NOT_SPACE.findall(k[-1][1])) if k else 0) for k, m in members.items()}
    leaves, saved = Counter(), Counter()
    for k in members:
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += own[k]
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    helpers.sha(",".join(map(str, sorted(c for c in m if len(made[c]) == len(k)))))) for k, m in members.items()), key=str)


def conversations():
    rng = random.Random(6)
    rows = []
    for c in [*range(130), -45, -40, -3, 10**12 + 7]:
        for i in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, i, rng.choice(["user", "assistant", None]), rng.choice(["hello", "Hello there", "", None, "tell me more\tof it"])))
    rows += [(200, i, "user", f"turn {i} of many") for i in range(500)] + [(201, i, "user", f"turn {i} of many") for i in range(500)]
    rows += [(5, None, "user", "null turn"), (7, 1, "user", "tie"), (7, 1, "user", "other tie"), (9, 0, "user", "again"), (9, 0, "user", "again")]
    rows += [(None, 0, "user", "no id"), (60, 9, "user", "word " * 5000)]
    return rows


def build(spark, rows):
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], "conv_id long, turn long, role string, text string, depth long, words string").repartition(5)
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turn_rows(df), 20, 4))


def test_trie(spark, monkeypatch):
    rows = conversations()
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    monkeypatch.setattr(scan, "RUN", 50)
    monkeypatch.setattr(prefix_trie, "list_ranks", lambda arcs: scan.list_ranks(arcs, 60))
    assert sorted(map(tuple, build(spark, rows).collect()), key=str) == shared(rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")], [(1, 0, "user", "x")], [(21, 0, "user", "x"), (20, 0, "a", "b")]])
def test_small_tries(spark, rows):
    assert sorted(map(tuple, build(spark, rows).collect()), key=str) == shared(rows)
