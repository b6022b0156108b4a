"""Substring deduplication with repeated-phrase automata.

A window is ``window`` consecutive words. Its phrase is the k-word run inside
it with the smallest hash, so equal windows have equal phrases at equal places,
and a document has about ``2 / (window - k + 2)`` phrases per word.

1. Phrases are collected from all documents as word sequences (with a hash of
   the context that their windows span) and grouped: a phrase that stands in two
   documents may belong to a recurring passage. If all its contexts are equal,
   the passage is confirmed by that, and the smallest doc_id owns it.
2. Documents are dealt to shards of bounded size. A shard's recurring phrases
   come first in its stream of rows and are compiled into one Aho-Corasick
   automaton over words (pyahocorasick, the digits of word numbers as letters,
   so a match is exact); its documents follow batch by batch and run through it. The places of
   phrases, and so the windows, are taken from the matches. Windows of confirmed
   passages are decided there; the others leave as hashes with their shard, and
   their documents stay open.
3. Those windows are grouped over all shards; one that stands in two documents
   is confirmed and owned by the smallest doc_id. A second stream brings each
   shard its confirmed windows, then its open documents.

Nothing is grouped by document pairs, a task holds one automaton and one batch,
and a passage that a third of the documents share is a few rows per shard.
Contexts and windows are compared by 128 bits of hash.

Defined cases: a null text has no words; texts of fewer than ``window`` words
lose nothing; a document with a null doc_id neither owns nor loses a window;
rows that repeat a doc_id are not smaller than each other, so both keep a
passage that only they hold. doc_id may have any type that has an order; the
result keeps it. Texts of any length are read whole (a slice holds at least one
document). An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.arrays import (NOT_SPACE, P_WORD, SAME, U64, Words, as_long, mix, prefix_sums, run_hash, slices,
                                  sliding_argmin, text_array)
from turnstone.llm.shared import shuffle_parts, stage

WINDOW = 50
K = 8
SHARD_BYTES = 4 << 20
#: rows of one batch of windows
OUT_ROWS = 1 << 16
#: edges that a node of the automaton has at most
BASE = 64


class Phrases:
    """The phrases of a slice and the windows they stand for."""

    def __init__(self, s, window: int, k: int):
        self.slice, self.window, self.k = s, window, k
        self.words = w = Words(s, NOT_SPACE, SAME)
        self.sums = prefix_sums(w.hash, P_WORD)
        n = w.n - window + 1
        at = np.arange(max(w.n - k + 1, 0))
        self.grams = run_hash(self.sums, at, at + k)
        if n <= 0:
            self.place = self.first = self.last = self.doc = np.empty(0, np.int64)
        else:
            start = np.flatnonzero(w.doc[:n] == w.doc[window - 1:])
            best = sliding_argmin(self.grams, window - k + 1)[start]
            new = np.ones(len(start), bool)
            new[1:] = (best[1:] != best[:-1]) | (w.doc[start[1:]] != w.doc[start[:-1]])
            a = np.flatnonzero(new)
            self.place = best[a]  # word where the phrase begins
            self.first = start[a]  # its first and last window
            self.last = start[np.append(a[1:], len(start)) - 1] if len(a) else start[:0]
            self.doc = w.doc[self.first]
        self.hash = self.grams[self.place]

    def context(self) -> np.ndarray:
        run = run_hash(self.sums, self.first, self.last + self.window)
        return mix(run ^ ((self.place - self.first).astype(U64) << U64(32)))

    def windows(self, rows: np.ndarray):
        """All windows of the given phrases: row of the phrase, start, and the two hashes that name the window."""
        n = self.last[rows] - self.first[rows] + 1
        row = np.repeat(rows, n)
        start = np.repeat(self.first[rows], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key = mix(self.hash[row] + (self.place[row] - start).astype(U64))
        return row, start, key, run_hash(self.sums, start, start + self.window)

    def outcome(self, doc: int, starts: np.ndarray) -> tuple[int, int, str]:
        """n_words, n_removed and the digest of the kept words when the windows at ``starts`` go."""
        return outcome(self.slice.text(doc).split(), starts, self.window)


def outcome(words: list[bytes], starts, window: int) -> tuple[int, int, str]:
    kept = words
    if len(starts):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, np.asarray(starts) + window, -1)
        keep = np.cumsum(edge[:-1]) == 0
        kept = [x for x, y in zip(words, keep.tolist()) if y]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _sharded(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, shard) and the number of shards; they have about SHARD_BYTES whatever the input size."""
    narrow = docs.select(docs["doc_id"], docs["text"])
    total = narrow.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0
    n = max(1, int(total // SHARD_BYTES) + 1)
    return narrow.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))), n


def _collect_phrases(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(phrase, context, doc_id, shard) of every place; a phrase is its words with one space between."""

    def run(batches):
        for batch in batches:
            for s in slices(text_array(batch)):
                p = Phrases(s, window, k)
                at = pa.array(p.doc + s.first)
                raw = s.data.tobytes()
                first, last = p.words.start[p.place].tolist(), p.words.end[p.place + k - 1].tolist()
                text = pa.array([b" ".join(raw[x:y].split()) for x, y in zip(first, last)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [text.cast(pa.string()), pa.array(as_long(p.context())), batch.column(0).take(at),
                     batch.column(2).take(at)], ["phrase", "context", "doc_id", "shard"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.where("doc_id IS NOT NULL").mapInArrow(run, f"phrase string, context bigint, doc_id {kind}, shard bigint")


class Automaton:
    """The recurring phrases of a shard, compiled.

    A node's edges are searched one after another, and with words as letters the root has an edge for each first word
    of a phrase. So a word is written as the digits of its number, with other letters for each digit, and no node has
    more than ``BASE`` edges however many phrases there are. NUL is any word that no phrase has.
    """

    def __init__(self):
        self.known: dict[bytes, tuple] = {}
        self.code: dict[bytes, str] = {}
        self.machine = None

    def add(self, phrase: bytes, owner, several: bool) -> None:
        self.known[phrase] = (owner, several)

    def compile(self) -> None:
        phrases = [(phrase.split(b" "), value) for phrase, value in self.known.items()]
        number = dict.fromkeys(w for words, _ in phrases for w in words)
        self.digits = 1
        while BASE ** self.digits < len(number):
            self.digits += 1
        self.code = {w: "".join(chr(1 + BASE * j + i // BASE ** j % BASE) for j in range(self.digits))
                     for i, w in enumerate(number)}
        self.machine = ahocorasick.Automaton()
        for words, value in phrases:
            self.machine.add_word("".join(map(self.code.__getitem__, words)), (len(words), *value))
        self.known.clear()
        if self.code:
            self.machine.make_automaton()

    def places(self, words: list[bytes]) -> dict[int, tuple]:
        """Where phrases begin in a document's words, with their owner and whether they have several contexts."""
        if not self.code:
            return {}
        text = "".join(map(self.code.get, words, repeat("\0" * self.digits)))
        return {(end + 1) // self.digits - n: (owner, several) for end, (n, owner, several) in self.machine.iter(text)}


def _groups(batch: pa.RecordBatch):
    """Runs of rows of one shard and kind: (shard, kind, rows)."""
    shard, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
    for a, b in zip([0, *cut], [*cut, len(shard)]):
        if b > a:
            yield shard[a], kind[a], batch.slice(a, b - a)


def _locate(window: int, k: int, id_type):
    """Stream of shards: phrases (kind 0), then documents (kind 1)."""

    names = ["kind", "shard", "doc_id", "n_words", "n_removed", "kept_sha256", "text", "gone", "key", "content", "low",
             "high"]
    types = [pa.int32(), pa.int64(), id_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()),
             pa.int64(), pa.int64(), id_type, id_type]

    def out(kind, shard, **columns):
        n = len(next(iter(columns.values())))
        columns |= {"kind": np.full(n, kind, np.int32), "shard": np.full(n, shard, np.int64)}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types)], names=names)

    def windows(shard, found):
        """The different windows of a shard's open places, with the smallest and largest of their documents."""
        order = sorted({x for _, _, _, ids in found for x in ids})
        rank = {x: i for i, x in enumerate(order)}
        key, content = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        doc = np.concatenate([np.array([rank[x] for x in ids], np.int64)[at] for _, _, at, ids in found])
        o = np.lexsort((doc, content, key))
        key, content, doc = key[o], content[o], doc[o]
        new = np.ones(len(o), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(o)) - 1
        ids = pa.array(order, id_type)
        for i in range(0, len(a), OUT_ROWS):
            x, y = a[i:i + OUT_ROWS], b[i:i + OUT_ROWS]
            yield out(2, shard, key=as_long(key[x]), content=as_long(content[x]), low=ids.take(pa.array(doc[x])),
                      high=ids.take(pa.array(doc[y])))

    def slice_(s, ids, machine):
        done, open_ = [], []
        phrases = None
        rows_, mine_ = [], []
        for d in range(s.n):
            words = s.text(d).split()
            found = machine.places(words) if ids[d] is not None else {}
            if not found:
                done.append((ids[d], *outcome(words, (), window)))
                continue
            if phrases is None:
                phrases = Phrases(s, window, k)
                cut = np.searchsorted(phrases.doc, np.arange(s.n + 1))
            base = phrases.words.first[d]
            sure, open_rows = [], []
            for row in range(cut[d], cut[d + 1]):
                hit = found.get(int(phrases.place[row] - base))
                if hit is None:
                    continue
                if hit[1]:
                    open_rows.append(row)
                elif hit[0] < ids[d]:
                    sure.append(row)
            starts = phrases.windows(np.array(sure, np.int64))[1] - base
            if open_rows:
                rows_ += open_rows
                mine_.append(d)
                open_.append((ids[d], s.text(d).decode("utf-8", "surrogatepass"), starts.tolist()))
            else:
                done.append((ids[d], *outcome(words, starts, window)))
        if not rows_:
            return done, open_, None
        row, _, key, content = phrases.windows(np.array(rows_, np.int64))
        at = np.searchsorted(mine_, phrases.doc[row])
        return done, open_, (key, content, at, [ids[d] for d in mine_])

    def run(batches):
        machine, now, found = None, None, []
        for batch in batches:
            for shard, kind, rows in _groups(batch):
                if shard != now:
                    if found:
                        yield from windows(now, found)
                    machine, now, found = Automaton(), shard, []
                if kind == 0:
                    for phrase, owner, several in zip(rows.column(2).cast(pa.binary()).to_pylist(),
                                                      rows.column(3).to_pylist(), rows.column(4).to_pylist()):
                        machine.add(phrase, owner, several)
                    continue
                if machine.machine is None:
                    machine.compile()
                ids = rows.column(3).to_pylist()
                for s in slices(rows.column(2)):
                    done, open_, win = slice_(s, ids[s.first:s.first + s.n], machine)
                    if done:
                        yield out(0, shard, **dict(zip(names[2:6], zip(*done))))
                    if open_:
                        yield out(1, shard, **dict(zip(("doc_id", "text", "gone"), zip(*open_))))
                    if win:
                        found.append(win)
        if found:
            yield from windows(now, found)

    return run


def _finish(window: int, k: int, id_type):
    """Stream of shards: confirmed windows (kind 0), then open documents (kind 1)."""

    def run(batches):
        now, held, name = None, [], None
        key = content = low = None
        for batch in batches:
            for shard, kind, rows in _groups(batch):
                if shard != now:
                    now, held, name = shard, [], None
                if kind == 0:
                    held.append((rows.column(5).to_numpy().view(np.uint64), rows.column(6).to_numpy().view(np.uint64),
                                 rows.column(3).to_pylist()))
                    continue
                if name is None:
                    key, content = (np.concatenate([h[i] for h in held]) if held else np.empty(0, U64) for i in (0, 1))
                    name = mix(key ^ mix(content))  # both hashes in one search; both are compared below
                    order = np.argsort(name)
                    name, key, content = name[order], key[order], content[order]
                    flat = [x for h in held for x in h[2]]
                    low = [flat[i] for i in order]
                ids, before = rows.column(3).to_pylist(), rows.column(4).to_pylist()
                for s in slices(rows.column(2)):
                    p = Phrases(s, window, k)
                    row, start, wk, wc = p.windows(np.arange(len(p.place)))
                    hit, at = _found(name, mix(wk ^ mix(wc)))
                    if len(name):
                        hit &= (key[at] == wk) & (content[at] == wc)
                    mine = ids[s.first:s.first + s.n]
                    doc = p.doc[row]
                    hit = np.flatnonzero(hit)
                    ok = [low[a] < mine[d] for a, d in zip(at[hit].tolist(), doc[hit].tolist())]
                    hit = hit[np.array(ok, bool)]
                    doc, start = doc[hit], start[hit]
                    start = start - p.words.first[doc]
                    o = np.argsort(doc, kind="stable")
                    start, cut = start[o], np.searchsorted(doc[o], np.arange(s.n + 1))
                    made = [(mine[d], *p.outcome(d, np.concatenate(
                        [start[cut[d]:cut[d + 1]], np.array(before[s.first + d], np.int64)]))) for d in range(s.n)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in made], id_type), pa.array([x[1] for x in made], pa.int64()),
                         pa.array([x[2] for x in made], pa.int64()), pa.array([x[3] for x in made], pa.string())],
                        names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys, at


def _in_order(rows: DataFrame, tasks: int) -> DataFrame:
    return rows.repartition(tasks, "shard").sortWithinPartitions("shard", "kind")


def drop_repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_kind, id_type = docs.schema["doc_id"].dataType.simpleString(), to_arrow_type(docs.schema["doc_id"].dataType)
    sharded, shards = _sharded(docs)
    tasks = max(shuffle_parts(docs.sparkSession), shards)
    seen = stage(_collect_phrases(sharded, window, k), "phrases")
    recurring = stage(seen.groupBy("phrase").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("last_doc"),
        (F.min("context") != F.max("context")).alias("several"))
        .where("owner < last_doc").select("phrase", "owner", "several"), "recurring")
    # a passage with one context is lost only by later documents
    phrases = seen.select("phrase", "shard", "doc_id").join(recurring, "phrase").where("several OR owner < doc_id").select(
        "shard", F.lit(0).alias("kind"), F.col("phrase").alias("text"), F.col("owner").alias("id"), "several")
    texts = sharded.select("shard", F.lit(1).alias("kind"), "text", F.col("doc_id").alias("id"),
                           F.lit(False).alias("several"))
    first = stage(_in_order(phrases.unionByName(texts), tasks).mapInArrow(
        _locate(window, k, id_type),
        f"kind int, shard bigint, doc_id {id_kind}, n_words bigint, n_removed bigint, kept_sha256 string, text string, "
        f"gone array<bigint>, key bigint, content bigint, low {id_kind}, high {id_kind}"), "shards")
    windows = first.where("kind = 2")
    confirmed = stage(windows.groupBy("key", "content").agg(F.min("low").alias("low"), F.max("high").alias("high"))
                      .where("low < high").select("key", "content", "low"), "confirmed")
    wanted = windows.select("shard", "key", "content").join(confirmed, ["key", "content"]).select(
        "shard", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), F.col("low").alias("id"),
        F.lit(None).cast("array<bigint>").alias("gone"), "key", "content")
    open_ = first.where("kind = 1").select(
        "shard", "kind", "text", F.col("doc_id").alias("id"), "gone", F.lit(0).cast("bigint").alias("key"),
        F.lit(0).cast("bigint").alias("content"))
    rest = _in_order(wanted.unionByName(open_), tasks).mapInArrow(
        _finish(window, k, id_type), f"doc_id {id_kind}, n_words bigint, n_removed bigint, kept_sha256 string")
    return first.where("kind = 0").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(rest)


SQL = """
WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM dw WHERE len(w) >= 50),
g AS MATERIALIZED (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS g FROM p),
o AS (SELECT g, min(doc_id) AS first_doc FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM g JOIN o ON g.g = o.g AND g.doc_id > o.first_doc),
r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w
              ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' '), '')) AS kept_sha256
FROM dw LEFT JOIN r ON dw.doc_id = r.doc_id
"""
