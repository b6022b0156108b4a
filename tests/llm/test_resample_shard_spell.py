"""Importance resampling, sharding and spelling variants against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from turnstone.llm import importance, sharding, spelling

from .conftest import frame, hard_rows, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[A-Za-zÀ-ÿ]+")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- resampling -------------------------------------------------------------------------------------------------

def grams(text, sizes):
    w = WORD.findall((text or "").translate(LOW))
    return w, [" ".join(w[i:i + n]) for n in range(sizes[0], sizes[1] + 1) for i in range(len(w) - n + 1)]


def resample_brute(data, target, share=10, sizes=(1, 1), buckets=10_000, least=20, seed=2024):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in data for g in grams(t, sizes)[1])
    t = Counter(bucket(g) for x in target for g in grams(x, sizes)[1])
    S, T = sum(s.values()), sum(t.values())
    out, ranked = [], []
    for i, text in data:
        w, f = grams(text, sizes)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in map(bucket, f))
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(w) >= least:
                ranked.append((-score, i, len(f), weight, len(out)))
        out.append([i, len(f), weight, score, None, len(w)])
    for r, x in enumerate(sorted(ranked)[:len(ranked) * share // 100], 1):
        out[x[-1]][4] = r
    return sorted((tuple(x) for x in out), key=str)


@pytest.mark.parametrize("options", [{}, {"share": 50, "least": 3}, {"share": 100, "least": 1, "sizes": (1, 3), "buckets": 97}])
def test_resample(spark, hard, empty, options):
    target = ["one two three w7 w9", None, "", " ".join(words(50, 9))]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    mine = {("min_words" if k == "least" else k): v for k, v in options.items()}
    assert rows(importance.resample(hard, goal, **mine)) == resample_brute(hard_rows(), target, **options)
    assert importance.resample(empty, goal, **mine).collect() == []
    assert rows(importance.resample(hard, goal.limit(0), **mine)) == resample_brute(hard_rows(), [], **options)


def test_resample_a_third_of_the_rows_alike(spark):
    data = [(7 if i % 3 == 0 else i, "same words all over " * 6 if i % 3 == 0 else " ".join(words(40, i))) for i in range(900)]
    got = importance.resample(frame(spark, data), spark.createDataFrame([("same words",)], "text string"), share=60).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 541))
    assert rows(spark.createDataFrame(got)) == resample_brute(data, ["same words"], share=60)


def test_overlapped_scan_gives_every_gram():
    text = "Ünïcode  a-b\x00c\n\nLONG " + "x" * 50_000 + " end. 1 2 3 "
    flat = importance.collapse(text.encode())
    for n in (1, 2, 3, 7):
        assert [m.group().decode() for m in importance.scanner(n)(flat)] == grams(text, (n, n))[1]
    assert list(importance.scanner(1)(importance.collapse(b"...\n"))) == []


def test_resample_keeps_rows_and_prefers_the_target(spark):
    data = [(i, " ".join((["law", "court"] if i % 5 == 0 else ["cake", "sugar"]) * 15)) for i in range(500)]
    docs = frame(spark, data)
    goal = spark.createDataFrame([("court law court law",)], "text string")
    got = importance.drawn_documents(docs, goal, share=10)
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == 50 and all(i % 5 == 0 for i in ids)


# ---- sharding ---------------------------------------------------------------------------------------------------

def check_shards(docs, got, shards):
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        places[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    held = Counter()
    for r in got:
        held[r["shard"]] += r["size"]
    return held


def test_shard_hard_rows(spark, hard, empty):
    check_shards(hard_rows(), sharding.shard(hard).collect(), 24)
    check_shards(hard_rows(), sharding.shard(hard, shards=1).collect(), 1)
    assert sharding.shard(empty).collect() == []


@pytest.mark.parametrize("hot", ["one text", "one row"])
def test_shards_are_even_with_a_hot_text(spark, hot):
    data = [(i if hot == "one text" or i % 3 else 0, "copied text " * 20 if i % 3 == 0 else " ".join(words(20 + i % 60, i)))
            for i in range(9000)]
    held = check_shards(data, got := sharding.shard(frame(spark, data)).collect(), 24)
    mean = sum(held.values()) / 24
    assert len(held) == 24 and max(held.values()) < 1.02 * mean and min(held.values()) > 0.98 * mean
    small = defaultdict(set)  # copies of an ordinary text stay together
    for r in got:
        small[r["text_crc32"]].add(r["shard"])
    assert sum(len(v) > 1 for v in small.values()) <= 1


def test_chunks_of_a_slot_number_gapless(spark):
    data = [(i, f"text {i}") for i in range(4000)]
    records = sharding.place_records(frame(spark, data), slots=8, shards=2)
    slot_map = spark.createDataFrame(sharding.first_map(sharding.slot_loads(records).collect(), 2), sharding.MAP)
    got = sharding.assign(records, slot_map, chunk_rows=50).collect()
    for s in (0, 1):
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert mine == list(range(len(mine)))


def held_by(rows_, loads, shards):
    held = [0] * shards
    weight = {(r["vslot"], r["piece"]): r["bytes"] for r in loads}
    for _, v, p, s in rows_:
        held[s] += weight.get((v, p), 0)
    return held


def test_map_versions_move_few_slots(spark, tmp_path):
    r = random.Random(4)
    loads = [{"vslot": i, "piece": 0, "bytes": r.randrange(1, 2000)} for i in range(4096)]
    total = sum(x["bytes"] for x in loads)
    one = sharding.first_map(loads, 24)
    more = sharding.rebalance(one, loads, 25)
    was = {(v, p): s for _, v, p, s in one}
    moved = [(k, was[k], s) for k, s in (((v, p), s) for _, v, p, s in more) if was[k] != s]
    assert moved and all(s == 24 for _, _, s in moved)  # only into the new shard
    weight = {x["vslot"]: x["bytes"] for x in loads}
    assert sum(weight[k[0]] for k, _, _ in moved) < 1.05 * total / 25
    held = held_by(more, loads, 25)
    assert max(held) < 1.03 * total / 25 and min(held) > 0.95 * total / 25
    changed = [dict(x, bytes=x["bytes"] * (3 if x["vslot"] % 24 == 5 else 1)) for x in loads]
    drift = sharding.rebalance(more, changed, 25)
    held = held_by(drift, changed, 25)
    assert max(held) - min(held) < 0.05 * sum(held) / 25
    less = sharding.rebalance(drift, changed, 20)
    assert {s for *_, s in less} <= set(range(20)) and len(less) == 4096
    path = str(tmp_path / "map")
    for version in (one, more, drift):
        sharding.write_map(spark, version, path)
    assert sorted(map(tuple, sharding.read_map(spark, path).collect())) == sorted(drift)
    assert sorted(map(tuple, sharding.read_map(spark, path, 1).collect())) == sorted(one)
    assert [x[0] for x in drift[:1]] == [3]


def test_stored_map_is_edited(spark, tmp_path):
    path = str(tmp_path / "map")
    data = [(i, " ".join(words(30, i))) for i in range(3000)]
    one = {r["doc_id"]: r for r in sharding.shard(frame(spark, data), shards=6, path=path).collect()}
    data += [(i, " ".join(words(30, i))) for i in range(3000, 3300)]
    two = sharding.shard(frame(spark, data), shards=7, current=sharding.read_map(spark, path), path=path).collect()
    check_shards(data, two, 7)
    assert {r["map_version"] for r in two} == {2} and {r["map_version"] for r in one.values()} == {1}
    kept = [r["shard"] == one[r["doc_id"]]["shard"] for r in two if r["doc_id"] in one]
    assert sum(kept) > 0.8 * len(kept)
    assert all(r["shard"] == 6 for r in two if r["doc_id"] in one and r["shard"] != one[r["doc_id"]]["shard"])


# ---- spelling ---------------------------------------------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def word_counts_brute(data, least=6, drop=199):
    n = Counter()
    for i, t in data:
        for w in LETTERS.findall((t or "").translate(LOW)):
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % drop == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least:
                n[w] += 1
    return n


def spelling_brute(data, least=6, times=5, ratio=5, drop=199):
    v = {w: c for w, c in word_counts_brute(data, least, drop).items() if c >= times}
    form, out = {}, []
    around = {w: [x for x in v if near(w, x)] for w in v}
    for w, xs in around.items():
        if xs:
            best = min(xs, key=lambda x: (-v[x], x))
            if v[best] >= ratio * v[w]:
                form[w] = best
    for w in v:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, v[w], len(around[w]), v[form[w]] if w in form else None))
    return sorted(out, key=str)


def spelling_rows():
    r = random.Random(11)
    base = ["running", "garden", "mountain", "vélocité", "ÀÉÎõü", "aaaaaaa", "straße" * 3, "q" * 40, "abcdefghijklmnopqr"]
    data = [(i, None if i % 17 == 0 else " ".join(r.choices(base, k=30))) for i in range(40)]
    for i in range(40, 200):
        w = list(r.choice(base))
        at = r.randrange(len(w))
        kind = r.randrange(3)
        if kind == 0:
            del w[at]
        elif kind == 1:
            w[at] = r.choice("aeÉz")
        else:
            w.insert(at, r.choice("aeÉz"))
        data.append((i % 90 if i % 50 else None, ", ".join(["".join(w)] * r.randrange(1, 40))))
    return data + hard_rows()


@pytest.mark.parametrize("group", [10_000, 3])
def test_spelling(spark, empty, group):
    data = spelling_rows()
    for options in ({}, {"least": 2, "times": 1, "ratio": 2, "drop": 7}):
        got = rows(spelling.spelling_variants(frame(spark, data), group=group, **options))
        assert got == spelling_brute(data, **options)
    assert any(r[1] for r in got)
    assert spelling.spelling_variants(empty).collect() == []
    assert spelling.spelling_variants(frame(spark, [(1, "rare words only")])).collect() == []


def test_spelling_chain_has_one_root(spark):
    chain = [("abcdefgh", 700), ("abcdefg", 100), ("abcdef", 15)]
    data = [(1, " ".join(" ".join([w] * n) for w, n in chain))]
    got = {r["word"]: r for r in spelling.spelling_variants(frame(spark, data), drop=10**9).collect()}
    assert [got[w]["root"] for w, _ in chain] == ["abcdefgh"] * 3 and got["abcdef"]["form"] == "abcdefg"


def test_word_counts_of_very_long_texts(spark):
    letters = "x" * 300_000 + "é" * 200_000
    data = [(1, letters + " " + "Garden garden " * 60_000), (2, "1" * 400_000), (None, "garden " * 3)]
    got = {r["word"]: r["n"] for r in spelling.count_words(frame(spark, data)).collect()}
    assert got == word_counts_brute(data)


def test_composition_accepts_exactly_the_pairs_at_one_edit():
    r = random.Random(3)
    v = sorted({"".join(r.choices("abé", k=r.randrange(1, 7))) for _ in range(300)})
    want = {tuple(sorted(p, key=lambda w: (len(w), w))) for p in ((x, y) for x in v for y in v) if near(*p)}
    found = [tuple(sorted((x, y), key=lambda w: (len(w), w))) for x, y, _ in spelling.OneEdit(spelling.Acceptor(v)).pairs()]
    assert len(found) == len(set(found)) and set(found) == want
    a = spelling.Acceptor(["tap", "taps", "top", "tops"])
    assert len(a.arcs) == 5  # shared endings are one state: the acceptor is minimal
    long = ["a" * 3000, "a" * 3001, "a" * 2999 + "b"]
    assert len(list(spelling.OneEdit(spelling.Acceptor(sorted(long))).pairs())) == 2


def test_a_hot_beginning_is_split_until_it_fits(spark):
    """A third of the vocabulary shares its first half; partitions stay within the bound and no pair is lost."""
    r = random.Random(8)
    v = {"prefixes" + "".join(r.choices("abcd", k=8)) for _ in range(400)} | {"".join(r.choices("abcdefgh", k=12)) for _ in range(800)}
    data = [(i, " ".join([w] * 5)) for i, w in enumerate(sorted(v))]
    got = rows(spelling.spelling_variants(frame(spark, data), group=20, drop=10**9))
    assert got == spelling_brute(data, drop=10**9)
