"""Exact, near, line and substring deduplication against brute force."""
import hashlib
import random
import re
from collections import Counter, defaultdict

from turnstone.llm import exact_dedup, graph, line_dedup, minmax_dedup, phrase_dedup

from .conftest import frame, hard_rows, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def union_find(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        up[top(a)] = top(b)
    return [top(i) for i in range(n)]


def exact_brute(data):
    groups = defaultdict(list)
    for i, t in data:
        groups[(t or "").translate(LOW)].append(i)
    out = []
    for i, t in data:
        g = groups[(t or "").translate(LOW)]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact(spark, hard, empty):
    assert rows(exact_dedup.exact_dedup(hard)) == exact_brute(hard_rows())
    assert exact_dedup.exact_dedup(empty).collect() == []
    kept = exact_dedup.drop_copies(hard)
    assert kept.columns == hard.columns
    gone = {i for i, _, _, k, _ in exact_brute(hard_rows()) if not k and i is not None}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in hard_rows() if i not in gone)


def test_exact_hot_digest_takes_the_broadcast_path(spark):
    data = [(i, "Hot Text" if i % 3 == 0 else f"text {i // 2}") for i in range(600)]
    assert rows(exact_dedup.exact_dedup(frame(spark, data), support=0.05)) == exact_brute(data)


def near_sets(data, k):
    out = []
    for _, t in data:
        w = SPACE.findall((t or "").translate(LOW))
        out.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def near_brute(data, k=4):
    sets = near_sets(data, k)
    named = [i for i, (d, _) in enumerate(data) if d is not None]
    links = [(a, b) for a in named for b in named if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = union_find(len(data), links)
    out = []
    for i, (d, _) in enumerate(data):
        c = None if d is None else min(data[j][0] for j in named if top[j] == top[i])
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def near_group(n, base_words, edits, seed):
    r = random.Random(seed)
    base = words(base_words, seed, 5_000)
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near(spark, hard, empty):
    # many copies on both sides of the threshold: links that no star finds must come out of the prefix filter
    texts = near_group(120, 150, 14, 1) + near_group(60, 60, 5, 2) + [" ".join(words(90, s)) for s in range(30)]
    data = hard_rows() + [(100 + i, t) for i, t in enumerate(texts)]
    assert rows(minmax_dedup.minmax_dedup(frame(spark, data))) == near_brute(data)
    assert minmax_dedup.minmax_dedup(empty).collect() == []


def test_near_stage_keeps_columns_and_unnamed_rows(spark, hard):
    kept = minmax_dedup.drop_near_copies(hard, k=5)
    assert kept.columns == hard.columns
    want = [d for d, _, _, k in near_brute(hard_rows(), 5) if k or d is None]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, want))


def test_signature_estimates_similarity():
    import numpy as np
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:3000], r.integers(0, 2**63, 1000, dtype=np.uint64)]))
    s = minmax_dedup.signatures([a, b], 512)
    assert abs(minmax_dedup.estimate(s[0], s[1]) - 0.6) < 0.06


def test_components_of_chains_hubs_and_nothing(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(500, 500), (900, 700), (700, 800)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {700: 700, 800: 700, 900: 700}
    assert got == want
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def lines_brute(data, k=8):
    at = defaultdict(list)
    for d, t in data:
        for n, line in enumerate((t or "").split("\n") if t is not None else []):
            if SPACE.search(line) and d is not None:
                at[line].append((d, n))
    ls = list(at)
    low = [x.translate(LOW) for x in ls]
    sets = [{x[i:i + k] for i in range(max(1, len(x) - k + 1))} for x in low]
    links, having = [], defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in having[g]).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                links.append((i, j))
        for g in s:
            having[g].append(i)
    top = union_find(len(ls), links)
    comp = defaultdict(set)
    for i, x in enumerate(ls):
        comp[top[i]] |= set(at[x])
    gone = defaultdict(set)
    for c in comp.values():
        for d, n in c - {min(c)}:
            gone[d].add(n)
    return sorted(((d, 0 if t is None else t.count("\n") + 1, len(gone.get(d, ())), sorted(gone.get(d, ()))) for d, t in data), key=str)


def test_lines(spark, hard, empty):
    base = "this is the common closing line of every document here, more or less"
    data = hard_rows() + [(200 + i, f"Document {i * 7919} speaks of its own matter {i * i}\n{base}{'!' * (i % 3)}\n \nend") for i in range(60)]
    assert rows(line_dedup.find_repeated_lines(frame(spark, data))) == lines_brute(data)
    assert line_dedup.find_repeated_lines(empty).collect() == []
    cut = {r.doc_id: r for r in line_dedup.drop_repeated_lines(frame(spark, data)).collect()}
    assert list(cut[16].asDict()) == hard.columns
    assert cut[200].text.endswith("\n \nend") and cut[201].text == "Document 7919 speaks of its own matter 1\n "
    assert cut[1].text is None and cut[2].text == ""


def phrase_brute(data, n):
    first = {}
    split = [SPACE.findall(t or "") for _, t in data]
    for (d, _), w in zip(data, split):
        for s in range(len(w) - n + 1):
            if d is not None:
                g = tuple(w[s:s + n])
                first[g] = min(first.get(g, d), d)
    out = []
    for (d, _), w in zip(data, split):
        gone = set()
        for s in range(len(w) - n + 1):
            if d is not None and first[tuple(w[s:s + n])] < d:
                gone |= set(range(s, s + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_phrases(spark, hard, empty):
    r = random.Random(3)
    shared = [words(70, 50 + i, 5_000) for i in range(4)]
    data = hard_rows()
    for i in range(60):  # whole passages, parts of them, and passages side by side
        w = words(r.randrange(20), 300 + i)
        for _ in range(r.randrange(3)):
            s = r.choice(shared)
            a = r.randrange(20)
            w += s[a:a + r.randrange(45, 70)] + words(r.randrange(5), 400 + i)
        data.append((100 + i, " ".join(w)))
    assert rows(phrase_dedup.drop_repeats(frame(spark, data))) == phrase_brute(data, 50)
    assert phrase_dedup.drop_repeats(empty).collect() == []


def test_phrase_places_come_from_the_automaton():
    import pyarrow as pa
    text = " ".join(words(60, 77, 5_000))
    s = next(iter(phrase_dedup.slices(pa.array([text]))))
    p = phrase_dedup.Phrases(s, 50, 8)
    w = text.split()
    phrases = [" ".join(w[i:i + 8]) for i in p.place.tolist()]

    def removed(known):
        def batch(shard, kind, texts, ids):
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array([shard] * n), pa.array([kind] * n, pa.int32()), pa.array(texts, pa.string()),
                                               pa.array(ids, pa.int64()), pa.array([False] * n)],
                                              names=["shard", "kind", "text", "id", "several"])
        run = phrase_dedup._locate(50, 8, pa.int64())
        out = list(run([batch(5, 0, known, [1] * len(known)), batch(5, 1, [text, text, None], [1, 2, 3])]))
        return {r["doc_id"]: r["n_removed"] for b in out for r in b.to_pylist()}

    assert removed(phrases) == {1: 0, 2: 60, 3: 0}
    assert removed([]) == {1: 0, 2: 0, 3: 0}  # without its patterns nothing is located
    a = phrase_dedup.Automaton()
    a.add(b"x y", 1, False)
    a.compile()
    assert a.places(b"x y x y z x".split()) == {0: (1, False), 2: (1, False)}


def test_phrases_with_text_ids_and_long_texts(spark):
    shared = words(90, 5, 9_000)
    big = words(150_000, 6, 60_000)
    data = [("b", " ".join(shared)), ("a", " ".join(words(10, 1) + shared)), ("c", " ".join(big)),
            ("d", "\t".join(big[40_000:41_000])), (None, " ".join(shared)), ("a", "x " * 300)]
    df = spark.createDataFrame(data, "doc_id string, text string")
    got = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in phrase_dedup.drop_repeats(df).collect()}
    assert got == {("b", 90): 90, ("a", 100): 0, ("c", 150_000): 0, ("d", 1000): 1000, (None, 90): 0, ("a", 300): 0}


def test_a_repeated_doc_id_with_another_text_loses_nothing(spark):
    from turnstone.llm import decontaminate
    same, other = "same words here now and then some", "unique text that stands only once here"
    leak = " ".join(words(20, 88))
    data = [(1, same), (1, other), (2, same), (3, leak), (3, "a clean text under the same number"), (4, None), (4, leak + " x"),
            (None, same)]
    docs = frame(spark, data)

    def left(df):
        assert df.columns == docs.columns
        return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)

    def want(gone):
        return sorted((x for x in data if x not in gone), key=str)

    assert left(exact_dedup.drop_copies(docs)) == want([(1, same)])
    got = left(minmax_dedup.drop_near_copies(docs, k=5))  # one row of each group; which one depends on the digests
    groups = [{(1, same), (2, same)}, {(3, leak), (4, leak + " x")}]
    assert all(len(g & set(got)) == 1 for g in groups)
    assert [x for x in got if not any(x in g for g in groups)] == want(groups[0] | groups[1])
    items = spark.createDataFrame([("q", leak)], "item_id string, text string")
    assert left(decontaminate.drop_leaks(docs, items)) == want([(3, leak), (4, leak + " x")])
    lines = [(1, "zeta one line here\nalpha line that is long enough"), (1, "zeta other\nkeeps this one too"),
             (2, "zeta one line here\nbeta line that is long enough")]
    wide = frame(spark, lines).withColumnRenamed("rep", "removed")
    got = {(r["doc_id"], r["text"]) for r in line_dedup.drop_repeated_lines(wide).collect()}
    assert got == {lines[0], lines[1], (2, "beta line that is long enough")}


def test_phrase_automaton_has_few_edges_at_each_node():
    from collections import Counter
    a = phrase_dedup.Automaton()
    w = [f"w{i}" for i in range(10_000)]
    for i in range(0, 9_992, 2):
        a.add(" ".join(w[i:i + 8]).encode(), i, i % 4 == 0)
    a.compile()
    _, edges, _ = a.machine.dump()
    assert max(Counter(x[0] for x in edges).values()) <= phrase_dedup.BASE
    found = a.places(" ".join(["other"] + w[4_000:4_011] + ["w7", "other"] + w[:8] + w[9_990:]).encode().split())
    assert found == {1: (4_000, True), 3: (4_002, False), 14: (0, True), 22: (9_990, False)}


def test_phrase_windows_leave_a_shard_once():
    import pyarrow as pa
    text = " ".join(words(60, 78, 5_000))
    w = text.split()
    p = phrase_dedup.Phrases(next(iter(phrase_dedup.slices(pa.array([text])))), 50, 8)
    phrases = [" ".join(w[i:i + 8]) for i in p.place.tolist()]
    fill = "x " * 600_000  # each text is a slice of its own

    def batch(shard, kind, texts, ids):
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([shard] * n), pa.array([kind] * n, pa.int32()), pa.array(texts, pa.string()),
                                           pa.array(ids, pa.int64()), pa.array([True] * n)],
                                          names=["shard", "kind", "text", "id", "several"])
    stream = [b for shard in (3, 4) for b in (batch(shard, 0, phrases, [1] * len(phrases)), batch(shard, 1, [text + " " + fill] * 3, [9, 7, 8]))]
    out = [r for b in phrase_dedup._locate(50, 8, pa.int64())(stream) for r in b.to_pylist()]
    rows = [(r["shard"], r["key"], r["content"]) for r in out if r["kind"] == 2]
    assert len(rows) == len(set(rows)) and {r[0] for r in rows} == {3, 4}
    assert {(r["low"], r["high"]) for r in out if r["kind"] == 2} == {(7, 9)}
    assert sorted(r["doc_id"] for r in out if r["kind"] == 1) == [7, 7, 8, 8, 9, 9]


def test_shared_line_keys_stream_by():
    import numpy as np
    import pyarrow as pa
    r = random.Random(11)
    rows = sorted([(r.randrange(400), r.randrange(5)) for _ in range(900)] + [(7, i) for i in range(50)] + [(9, 1)] * 40)
    ids = {}
    for k, i in rows:
        ids.setdefault(k, set()).add(i)
    want = sorted({(k, i) for k, i in rows if len(ids[k]) > 1})

    class Bands:  # stands for sorted rows in one partition
        def repartition(self, *_):
            return self

        def sortWithinPartitions(self, *_):
            return self

        def mapInArrow(self, run, _):
            for size in (1, 3, 64, 10_000):
                made = run(pa.RecordBatch.from_arrays([pa.array(np.array([x[j] for x in rows[a:a + size]], np.int64)) for j in (0, 1)],
                                                      ["key", "id"]) for a in range(0, len(rows), size))
                assert [(x["key"], x["id"]) for b in made for x in b.to_pylist()] == want
            assert list(run(iter([]))) == []

    line_dedup._shared(Bands())


def test_line_shingles_are_the_hashes_of_their_characters():
    import pyarrow as pa
    from turnstone.llm.arrays import slices
    texts = ["", "abcdefgh", "short", "ABCDEFGHIJ", "", "xéyézéwéqé日", "é", "abcdefghij", "日本語", ""]
    for column in (pa.array(texts), pa.array(texts[:5]), pa.array(["abcdefg"]), pa.array([""])):
        s = next(slices(column))
        h, row = line_dedup._shingles(s, 8)
        got = [(int(x), int(y)) for x, y in zip(h, row)]
        want = []
        for i, t in enumerate(column.to_pylist()):
            for run in ([t[j:j + 8] for j in range(len(t) - 7)] or [t][:len(t)]):
                one = next(slices(pa.array([run])))
                want.append((int(line_dedup._shingles(one, len(run))[0][0]), i))
        assert got == want


def test_line_texts_do_not_travel_for_bands(spark):
    plan = line_dedup._shared(line_dedup._bands(frame(spark, [(1, "a line of words")]).select("doc_id", "text"), 8))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 2 and "Aggregate" not in plan


def test_line_of_several_slices_leaves_its_task_once(monkeypatch):
    import numpy as np
    import pyarrow as pa
    texts = ["same line here\nother line here", "third line here\nsame line here"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], ["doc_id", "text"])

    def left(wanted=None):
        return [x for b in line_dedup._line_batches([batch, batch], wanted) for x in b.to_pylist()]

    found = {x["text"]: x["id"] for x in left()}
    assert sorted(x["text"] for x in left()) == ["other line here", "same line here", "third line here"]
    bits = np.zeros(line_dedup.WANTED // 8, np.uint8)
    assert left(bits) == []
    at = found["other line here"] & (line_dedup.WANTED - 1)
    bits[at >> 3] |= 1 << (at & 7)
    assert [x["text"] for x in left(bits)] == ["other line here"]
    monkeypatch.setattr(line_dedup, "SEEN", 0)  # remembers only one slice: lines leave again, none is lost
    assert {x["text"] for x in left()} == set(found)


def test_id_bits_are_those_of_the_ids(spark):
    import numpy as np
    ids = [-1, 0, 1, 7, 32767, 32768, 2 ** 63 - 1, -2 ** 63, 123456789012345]
    bits = line_dedup._id_bits(spark.createDataFrame([(i,) for i in ids], "id bigint"))
    want = sorted({i & (line_dedup.WANTED - 1) for i in ids})
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == want
