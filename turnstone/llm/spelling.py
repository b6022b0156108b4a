"""Spelling variants by finite-state composition.

1. Word counts. Words of a slice are packed into two 64-bit numbers (longer ones
   stay bytes), so distinct words and distinct (document, word) pairs are found
   exactly in numpy; a table-driven CRC-32 runs over all pairs at once and names
   the words of which one code point is dropped. Counts are added up map-side.
2. Partitions. The composition acceptor o one-edit transducer o acceptor accepts
   a pair by an equal beginning, one edit and an equal end. A pair's edit stands
   at its first difference, in [0, s] for a shorter word of ``s`` code points.
   This range is halved: pairs with a late edit begin in the same initial state
   (an equal first part), pairs with an early edit do so in the reversed machine
   (an equal last part). A partition is one such state; each word is in four of
   them. A partition of more than ``GROUP`` words is halved again by its range,
   until a range holds one place, which bounds it by the alphabet. No partition
   can hold a large share of the vocabulary, and every pair has one partition.
3. Each partition's words are compiled into a minimised acceptor, the composed
   machine is built from it (states after the edit are pairs of states, trimmed
   to those that still accept), and its accepted pairs are enumerated. Counts
   and the best form per word leave the task, not the pairs.
4. Roots follow the forms by pointer doubling; a form is at least ``ratio``
   times as frequent as its word, so chains are short and never circular.

Defined cases: a null text has no words; in a row without a doc_id no word is
altered; rows that repeat a doc_id count each; an empty table, or one without
frequent words, gives an empty result. Words and texts of any length are taken
whole. Equal counts: the smaller word in code-point order is the form. Further
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.arrays import LOWER, U64, mix, slices, text_array
from turnstone.llm.shared import shuffle_parts, stage

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
DROP = 199
GROUP = 10_000
ROWS_PER_TASK = 200_000

_b = np.arange(256)
_LETTER = ((_b >= 0x41) & (_b <= 0x5A)) | ((_b >= 0x61) & (_b <= 0x7A))
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF, and of no other character
#: words of at most 16 bytes are two numbers; masks for the bytes of the first and the second
_MASK = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], U64)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


class Tokens:
    """Words of a slice that have at least ``least`` code points: byte ranges and texts, on folded bytes."""

    def __init__(self, s, least: int):
        self.data = data = LOWER[s.data]
        lead = data == _LEAD
        m = _LETTER[data] | lead
        m[1:] |= lead[:-1]
        o = s.offsets
        filled = o[1:] > o[:-1]
        begin, last = o[:-1][filled], o[1:][filled] - 1
        a = m.copy()
        a[1:] &= ~m[:-1]
        a[begin] = m[begin]
        z = m.copy()
        z[:-1] &= ~m[1:]
        z[last] = m[last]
        start, end = np.flatnonzero(a), np.flatnonzero(z) + 1
        two = np.concatenate([[0], np.cumsum(lead)])
        ok = (end - start) - (two[end] - two[start]) >= least
        self.start, self.end = start[ok], end[ok]
        self.doc = np.searchsorted(o, self.start, side="right") - 1

    def packed(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.concatenate([self.data, np.zeros(16, np.uint8)])
        view = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        n = self.end[at] - self.start[at]
        return (view[self.start[at]] & _MASK[np.minimum(n, 8)],
                view[self.start[at] + 8] & _MASK[np.clip(n - 8, 0, 8)])

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def strings(self, at: np.ndarray) -> pa.Array:
        n = self.end[at] - self.start[at]
        cut = np.concatenate([[0], np.cumsum(n)])
        flat = np.repeat(self.start[at] - cut[:-1], n) + np.arange(cut[-1])
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(self.data[flat]))


def _runs(key: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where its runs of rows that agree in all of ``same`` begin."""
    order = np.argsort(key)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in same:
        x = x[order]
        new[1:] |= x[1:] != x[:-1]
    return order, np.flatnonzero(new)


def _crcs(w0: np.ndarray, w1: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """CRC-32 of packed words of ``n`` bytes, each continued from its seed."""
    order = np.argsort(-n, kind="stable")
    w0, w1, c = w0[order], w1[order], seed[order] ^ np.uint32(0xFFFFFFFF)
    live = np.searchsorted(-n[order], -np.arange(17), side="left")  # words longer than j bytes: the first live[j]
    for j in range(16):
        k = live[j]
        if not k:
            break
        byte = ((w0[:k] >> U64(8 * j)) if j < 8 else (w1[:k] >> U64(8 * j - 64))).astype(np.uint32) & np.uint32(255)
        c[:k] = _CRC[(c[:k] ^ byte) & np.uint32(255)] ^ (c[:k] >> np.uint32(8))
    out = np.empty_like(c)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    return out


def _altered(word: bytes, crc: int, least: int) -> str | None:
    """The word without one code point; None if too few are left."""
    w = word.decode("utf-8", "replace")
    at = crc % len(w)
    return w[:at] + w[at + 1:] if len(w) > least else None


def count_words(docs: DataFrame, least: int = MIN_CHARS, drop: int = DROP) -> DataFrame:
    """(word, n): words of at least ``least`` code points, after the drops, with their occurrences."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for s in slices(text_array(batch)):
                t = Tokens(s, least)
                if not len(t.start):
                    continue
                mine = ids[s.first:s.first + s.n]
                named = np.array([i is not None for i in mine], bool)
                seed = np.array([zlib.crc32(f"{i}:".encode()) for i in mine], np.uint32)
                size = t.end - t.start
                other: Counter = Counter()  # words that were altered, and those too long to pack
                long = np.flatnonzero(size > 16)
                for (d, w), n in Counter((int(t.doc[i]), t.word(i)) for i in long).items():
                    c = zlib.crc32(w, int(seed[d]))
                    if named[d] and c % drop == 0:
                        other[_altered(w, c, least)] += n
                    else:
                        other[w.decode("utf-8", "replace")] += n
                at = np.flatnonzero(size <= 16)
                w0, w1 = t.packed(at)
                h = mix(w0 ^ mix(w1 + U64(0x9E3779B97F4A7C15)))
                order, first = _runs(mix(h + t.doc[at].astype(U64) * U64(0xD6E8FEB86659FD93)), t.doc[at], w0, w1)
                times = np.diff(np.append(first, len(order)))
                pair = order[first]  # one of each word of a document
                doc = t.doc[at[pair]]
                c = _crcs(w0[pair], w1[pair], size[at[pair]], seed[doc])
                hit = named[doc] & (c % np.uint32(drop) == 0)
                for i, x, n in zip(at[pair[hit]].tolist(), c[hit].tolist(), times[hit].tolist()):
                    other[_altered(t.word(i), x, least)] += n
                pair, times = pair[~hit], times[~hit]
                order, first = _runs(h[pair], w0[pair], w1[pair])
                if len(first):
                    yield pa.RecordBatch.from_arrays(
                        [t.strings(at[pair[order[first]]]), pa.array(np.add.reduceat(times[order], first), pa.int64())],
                        ["word", "n"])
                other.pop(None, None)
                if other:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(other), pa.string()), pa.array(list(other.values()), pa.int64())], ["word", "n"])

    counted = docs.select(docs["doc_id"], docs["text"]).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """Minimal deterministic acceptor of words that are added in ascending order; state 0 is the end without arcs."""

    def __init__(self, words):
        self.arcs: list[dict] = []
        self.final: list[bool] = []
        self._known: dict = {}
        path: list[list] = [[{}, False]]  # open states of the last word: arcs, final
        chars: list[str] = []
        for w in words:
            keep = 0
            while keep < len(chars) and keep < len(w) and chars[keep] == w[keep]:
                keep += 1
            self._close(path, chars, keep)
            del chars[keep:]
            for ch in w[keep:]:
                chars.append(ch)
                path.append([{}, False])
            path[-1][1] = True
        self._close(path, chars, 0)
        self.start = self._state(path[0])

    def _state(self, node) -> int:
        key = (node[1], tuple(node[0].items()))
        q = self._known.get(key)
        if q is None:
            q = self._known[key] = len(self.arcs)
            self.arcs.append(node[0])
            self.final.append(node[1])
        return q

    def _close(self, path, chars, keep: int) -> None:
        while len(path) > keep + 1:
            q = self._state(path.pop())
            path[-1][0][chars[len(path) - 1]] = q


class OneEdit:
    """The acceptor composed with a one-edit transducer and itself, as far as both sides can still accept.

    Before the edit both sides are in one state. An edit arc replaces a code
    point (each pair of letters once) or inserts one on the second side; after
    it the machine is in a pair of states and reads the same letter on both.
    """

    def __init__(self, a: Acceptor):
        self.a = a
        self._after: dict[tuple[int, int], list | None] = {}
        self._edits: dict[int, list] = {}
        self.alive: list[bool] = []
        for q in range(len(a.arcs)):  # arcs lead to states made earlier, so one pass settles what is reachable
            self.alive.append(bool(self.edits(q)) or any(self.alive[t] for t in a.arcs[q].values()))

    def after(self, pair: tuple[int, int]):
        """Arcs (letter, pair) out of a pair of states that lead to acceptance; None if none does and it is not final."""
        done = self._after
        stack = [pair]
        while stack:
            p = stack[-1]
            if p in done:
                stack.pop()
                continue
            one, two = self.a.arcs[p[0]], self.a.arcs[p[1]]
            if len(one) > len(two):
                to = [(ch, (one[ch], q)) for ch, q in two.items() if ch in one]
            else:
                to = [(ch, (q, two[ch])) for ch, q in one.items() if ch in two]
            wait = [t for _, t in to if t not in done]
            if wait:
                stack.extend(wait)
                continue
            to = [(ch, t) for ch, t in to if done[t] is not None]
            done[p] = to if to or self.both_final(p) else None
            stack.pop()
        return done[pair]

    def both_final(self, p: tuple[int, int]) -> bool:
        return self.a.final[p[0]] and self.a.final[p[1]]

    def edits(self, q: int) -> list:
        """(letters of the first side, of the second side, pair of states) for the edits that can be completed in q."""
        if q not in self._edits:
            arcs = list(self.a.arcs[q].items())
            found = [("", ch, (q, t)) for ch, t in arcs]
            found += [(x, y, (s, t)) for i, (x, s) in enumerate(arcs) for y, t in arcs[i + 1:]]
            self._edits[q] = [e for e in found if self.after(e[2]) is not None]
        return self._edits[q]

    def pairs(self):
        """All (x, y, first difference), y being longer by one or as long; each pair once."""
        a, head = self.a, []
        stack = [(0, "", a.start)]
        while stack:
            depth, ch, q = stack.pop()
            if depth:
                del head[depth - 1:]
                head.append(ch)
            if not self.alive[q]:
                continue
            for x, y, p in self.edits(q):
                before = "".join(head)
                for tail in self._tails(p):
                    if not x and tail[:1] == y:
                        continue  # the same letter follows: the pair differs first further on, and is found there
                    yield before + x + tail, before + y + tail, depth
            stack.extend((depth + 1, c, t) for c, t in a.arcs[q].items())

    def _tails(self, pair):
        tail: list[str] = []
        stack = [(0, "", pair)]
        while stack:
            depth, ch, p = stack.pop()
            if depth:
                del tail[depth - 1:]
                tail.append(ch)
            if self.both_final(p):
                yield "".join(tail)
            stack.extend((depth + 1, c, t) for c, t in self.after(p))


def near_pairs(words: list[str], size: int, low: int, high: int):
    """Pairs at one edit among ascending ``words``, the shorter of ``size`` code points, first difference in [low, high)."""
    for x, y, at in OneEdit(Acceptor(words)).pairs():
        if min(len(x), len(y)) == size and low <= at < high:
            yield x, y


_KEY = ["size", "low", "high", "head", "tail"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (size, low, high, word, n) with what all words of a partition share: the code points before and after the range."""
    return rows.select("size", "low", "high", F.expr("substring(word, 1, low)").alias("head"),
                       F.expr("right(word, greatest(size - high, 0))").alias("tail"), "word", "n")


def _halves(rows: DataFrame) -> DataFrame:
    mid = F.expr("int((low + high) / 2)")
    return _keyed(rows.select("size", "word", "n", F.explode(F.array(
        F.struct("low", mid.alias("high")), F.struct(mid.alias("low"), "high"))).alias("r"))
        .select("size", "r.low", "r.high", "word", "n"))


def _enumerate(rows: DataFrame) -> DataFrame:
    """(word, near, best_n, best) per word and partition."""

    def of(group: list[tuple], key: tuple):
        count = dict(group)
        found: dict[str, list] = {}
        for x, y in near_pairs([w for w, _ in group], *key):
            for w, v in ((x, y), (y, x)):
                have = found.get(w)
                if have is None:
                    found[w] = [1, -count[v], v]
                else:
                    have[0] += 1
                    if (-count[v], v) < (have[1], have[2]):
                        have[1], have[2] = -count[v], v
        return found

    def run(batches):
        group: list[tuple] = []
        key = None
        out: list[tuple] = []

        def flush():
            part = pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()),
                pa.array([-x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.string())],
                ["word", "near", "best_n", "best"])
            out.clear()
            return part

        for batch in batches:
            size, low, high, head, tail, word, n = (c.to_pylist() for c in batch.columns)
            for k, w, c in zip(zip(size, low, high, head, tail), word, n):
                if k != key:
                    if len(group) > 1:
                        out.extend((x, *v) for x, v in of(group, key[:3]).items())
                        if len(out) > 20_000:
                            yield flush()
                    key, group = k, []
                group.append((w, c))
        if len(group) > 1:
            out.extend((x, *v) for x, v in of(group, key[:3]).items())
        if out:
            yield flush()

    return rows.mapInArrow(run, "word string, near bigint, best_n bigint, best string")


def links(vocabulary: DataFrame, least: int = MIN_CHARS, group: int = GROUP) -> DataFrame:
    """(word, near, best_n, best): how many words stand at one edit, and the most frequent of them."""
    spark = vocabulary.sparkSession
    length = F.length("word")
    rows = _halves(vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("size"))
                   .where(F.col("size") >= least)
                   .select("size", F.lit(0).alias("low"), (F.col("size") + 1).alias("high"), "word", "n"))
    found = None
    while True:
        rows = stage(rows, "partitions")
        sizes = stage(rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "sizes")
        small = rows.join(sizes.where((F.col("m") <= group) | (F.col("high") - F.col("low") <= 1)), _KEY, "left_semi")
        tasks = max(shuffle_parts(spark), math.ceil((sizes.agg(F.sum("m")).first()[0] or 0) / ROWS_PER_TASK))
        part = _enumerate(small.repartition(tasks, *_KEY).sortWithinPartitions(*_KEY, "word"))
        found = part if found is None else found.unionByName(part)
        large = sizes.where((F.col("m") > group) & (F.col("high") - F.col("low") > 1))
        if large.isEmpty():
            break
        rows = _halves(rows.join(large, _KEY, "left_semi"))
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("b")).select(
        "word", "near", (-F.col("b.k")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that the forms lead to."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = MIN_CHARS, times: int = MIN_COUNT, ratio: int = RATIO,
                      drop: int = DROP, group: int = GROUP) -> DataFrame:
    """One row per frequent word: word, form, root, n, n_near, form_n."""
    words = stage(count_words(docs, least, drop).where(F.col("n") >= times), "vocabulary")
    near = stage(words.join(links(words, least, group), "word", "left").withColumn(
        "form_n", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n"))), "near")
    near = near.select("word", F.when(F.col("form_n").isNotNull(), F.col("best")).alias("form"), "n",
                       F.coalesce("near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
    root = roots(near.where("form IS NOT NULL"))
    return near.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_SQL_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({0}))),
  lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))))"""

SQL = f"""
WITH RECURSIVE dx AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents),
pairs AS (SELECT doc_id, w, count(*) AS n FROM dx WHERE length(w) >= 6 GROUP BY doc_id, w),
named AS (SELECT doc_id, w, n, {_SQL_CRC.format("(doc_id || ':' || w)")} AS h FROM pairs),
made AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM named),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k
                     FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT v.word, c.word, c.n FROM v JOIN cut c ON c.k = v.word
  UNION SELECT c.word, v.word, v.n FROM v JOIN cut c ON c.k = v.word),
best AS MATERIALIZED (SELECT word, count(*) AS n_near, max(other_n) AS m FROM near GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN best.m >= 5 * v.n THEN best.m END AS form_n,
      (SELECT min(other) FROM near WHERE near.word = v.word AND other_n = best.m AND best.m >= 5 * v.n) AS form
      FROM v LEFT JOIN best ON v.word = best.word),
walk AS (SELECT word, word AS root FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, root FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NULL)
SELECT f.word, f.form, ends.root, f.n, f.n_near, f.form_n FROM f JOIN ends ON f.word = ends.word
"""
