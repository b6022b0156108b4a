"""Benchmark decontamination by winnowing.

Winnowing keeps, of every ``w`` consecutive k-word hashes, the smallest one.
Two texts that share a run of ``k + w - 1`` words share at least one kept
fingerprint; with ``k = 5`` and ``w = 6`` that is every shared window of 10
words. Items with fewer than 10 words are one window of their own length n and
are fingerprinted with ``k = n`` and ``w = 1``, for which the same holds.

Fingerprints of documents and items are joined, and each joined place of a
document is extended to the windows around it that may hold the fingerprint.
The hashes of these windows are joined with those of the items' distinct
windows, and what meets is compared word by word. A repeated word or phrase
costs one comparison per place of the document, however often an item repeats
it: the work is linear in the document's words and in the items found.

The benchmark is the stated query set. It is cut into blocks of at most
``block_words`` words; one block's fingerprints and words go to the executors
(a size that is checked, not assumed) and all documents stream through without
a shuffle. With several blocks, the spans of a document are merged by one
grouping on narrow rows.

Defined cases: null text has no words; an item without words is ignored; a
null item_id is listed as ``null``; items that repeat an id count once; a
document that is null, empty or short has its row too. Documents that repeat a
doc_id keep one row each. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.llm.arrays import ALNUM, LOWER, P_WORD, Words, grams, prefix_sums, run_hash, slices, sliding_argmin, text_array
from turnstone.llm.shared import row_name, text_md5

WINDOW = 10
K = 5
BLOCK_WORDS = 2_000_000


def winnow(words: np.ndarray, doc: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept k-word hashes and their places; a text with fewer than w of them keeps none."""
    h, at = grams(words, doc, k)
    if w == 1 or len(h) < w:
        return (h, at) if w == 1 else (h[:0], at[:0])
    best = sliding_argmin(h, w)
    inside = doc[at[:len(best)]] == doc[at[w - 1:w - 1 + len(best)]]
    keep = np.unique(best[inside])
    return h[keep], at[keep]


class ItemIndex:
    """Fingerprints and distinct windows of one block of items."""

    def __init__(self, ids: list[str], texts: list[str], window: int, k: int):
        self.window, self.k, self.ids = window, k, ids
        self.number: dict[bytes, int] = {}  # word -> its number
        numbers, hashes, items = [], [], []
        for s in slices(pa.array(texts, pa.string())):
            w = Words(s, ALNUM, LOWER)
            mine = (s.data[x:y].tobytes().lower() for x, y in zip(w.start, w.end))
            numbers.append(np.array([self.number.setdefault(x, len(self.number)) for x in mine], np.int32))
            hashes.append(w.hash)
            items.append(w.doc + s.first)
        number = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
        hash_, item = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((hashes, np.uint64), (items, np.int64)))
        size_of = np.minimum(np.bincount(item, minlength=len(texts)), window)
        self.lists: list[tuple[int, ...]] = []  # the items that hold a window, each list once
        known: dict[tuple[int, ...], int] = {}
        self.tables = {}
        for size in np.unique(size_of[size_of > 0]).tolist():
            own = np.flatnonzero(size_of[item] == size)
            prints, _ = winnow(hash_[own], item[own], *self._shape(size))
            full, at = grams(hash_[own], item[own], size)
            content = number[own][at[:, None] + np.arange(size)]
            row = np.ascontiguousarray(content).view(f"V{4 * size}").ravel()
            _, first, group = np.unique(row, return_index=True, return_inverse=True)
            pairs = np.unique(np.stack([group, item[own][at]]), axis=1)
            cut = np.searchsorted(pairs[0], np.arange(len(first) + 1))
            held = np.empty(len(first), np.int64)
            for g in range(len(first)):
                of = tuple(pairs[1, cut[g]:cut[g + 1]].tolist())
                held[g] = known.setdefault(of, len(known))
                if len(known) > len(self.lists):
                    self.lists.append(of)
            order = np.argsort(full[first], kind="stable")
            self.tables[size] = (np.unique(prints), full[first][order], content[first][order], held[order])

    def _shape(self, size: int) -> tuple[int, int]:
        """Words of a fingerprint, and fingerprints of a window, for windows of ``size`` words."""
        return (self.k, size - self.k + 1) if size == self.window else (size, 1)

    def search(self, words: np.ndarray, doc: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Hit marks for all words, and the set of items found in each text."""
        hit = np.zeros(len(words), bool)
        items: dict[int, set[str]] = defaultdict(set)
        for size, (prints, full, content, held) in self.tables.items():
            kk, ww = self._shape(size)
            h, at = winnow(words, doc, kk, ww)
            at = at[prints[np.minimum(np.searchsorted(prints, h), len(prints) - 1)] == h]
            begin = np.unique(at[:, None] - np.arange(ww))
            begin = begin[(begin >= 0) & (begin + size <= len(words))]
            begin = begin[doc[begin] == doc[begin + size - 1]]
            if not len(begin):
                continue
            mine = run_hash(prefix_sums(words, P_WORD), begin, begin + size)
            lo, hi = np.searchsorted(full, mine, "left"), np.searchsorted(full, mine, "right")
            reps = hi - lo  # above one only where different windows share a hash
            begin = np.repeat(begin, reps)
            if not len(begin):
                continue
            window = np.repeat(lo - np.cumsum(reps) + reps, reps) + np.arange(len(begin))
            places = begin[:, None] + np.arange(size)
            read, back = np.unique(places, return_inverse=True)
            numbers = np.array([self.number.get(data[start[p]:end[p]].tobytes().lower(), -1) for p in read], np.int32)
            same = (numbers[back.reshape(places.shape)] == content[window]).all(axis=1)
            hit[places[same].ravel()] = True
            for d, x in np.unique(np.stack([doc[begin[same]], held[window[same]]]), axis=1).T.tolist():
                items[d].update(self.ids[i] for i in self.lists[x])
        return hit, items


def _blocks(items: DataFrame, block_words: int):
    """Items as blocks of at most ``block_words`` words (one item at least), one block in memory at a time."""
    ids, texts, size = [], [], 0
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    for r in rows.where(F.col("text").isNotNull()).toLocalIterator():
        n = len(r["text"]) // 2 + 1  # no more words than that
        if ids and size + n > block_words:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        size += n
    yield ids, texts


def _search_block(docs: DataFrame, ids, texts, window, k) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    index = spark.sparkContext.broadcast(ItemIndex(ids, texts, window, k))
    names = docs.columns

    def run(batches):
        for batch in batches:
            for s in slices(text_array(batch)):
                w = Words(s, ALNUM, LOWER)
                hit, found = index.value.search(w.hash, w.doc, s.data, w.start, w.end)
                edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
                a, z = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                spans: dict[int, list] = defaultdict(list)
                for x, y in zip(a, z):  # a run may cross from one text into the next
                    for d in range(int(w.doc[x]), int(w.doc[y - 1]) + 1):
                        f, g = int(w.first[d]), int(w.first[d + 1])
                        if max(x, f) < min(y, g):
                            spans[d].append([int(max(x, f)) - f, int(min(y, g)) - f])
                part = batch.slice(s.first, s.n)
                cols = [part.column(part.schema.get_field_index(c)) for c in names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(np.diff(w.first), pa.int64()),
                     pa.array([spans.get(i, []) for i in range(s.n)], pa.list_(pa.list_(pa.int64()))),
                     pa.array([sorted(found.get(i, ())) for i in range(s.n)], pa.list_(pa.string()))],
                    [*(c for c in names if c != "text"), "n_words", "hit_spans", "item_ids"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(run, f"{kept}, n_words bigint, hit_spans array<array<bigint>>, item_ids array<string>")


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, hit_spans ([first, end) word ranges), item_ids (sorted strings)."""
    narrow = docs.select(docs["doc_id"], docs["text"])
    blocks = _blocks(items, block_words)
    ids, texts = next(blocks)
    second = next(blocks, None)
    if second is None:
        return _search_block(narrow, ids, texts, window, k)
    keyed = narrow.withColumn("row_key", F.xxhash64("doc_id", "text"))
    parts = [_search_block(keyed, ids, texts, window, k), _search_block(keyed, *second, window, k)]
    parts += [_search_block(keyed, i, t, window, k) for i, t in blocks]
    # rows that repeat doc_id and text share a key; each appears once per block
    out = parts[0].withColumn("block", F.lit(0))
    for n, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("block", F.lit(n)))
    merged = (out.groupBy("doc_id", "row_key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_set("hit_spans")).alias("raw"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
        F.sum((F.col("block") == 0).cast("int")).alias("copies")))
    merged = merged.withColumn("hit_spans", _merge_spans("raw")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return merged.select("doc_id", "n_words", "hit_spans", "item_ids")


def _merge_spans(name: str):
    """Overlapping or touching spans of a sorted array become one."""
    zero = F.array().cast("array<array<bigint>>")

    def step(acc, x):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.array(last[0], F.greatest(last[1], x[1]))))
        return F.when((F.size(acc) > 0) & (x[0] <= F.get(F.get(acc, F.size(acc) - 1), F.lit(1))), joined).otherwise(
            F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(F.array_distinct(name)), zero, step)


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Digest per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_leaks(docs, items, **options)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda a, x: a + x[1] - x[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated rows; its columns are kept. Rows without a doc_id stay.

    A row is named by doc_id and text, so a clean text under the doc_id of a
    contaminated one stays.
    """
    named = docs.select(row_name(docs).alias("doc_id"), docs["text"])
    gone = decontaminate(named, items, **options).where("contaminated AND doc_id.doc_id IS NOT NULL").select(
        F.col("doc_id.doc_id").alias("gone_id"), F.col("doc_id.text_md5").alias("gone_md5")).distinct()
    same = (docs["doc_id"] == gone["gone_id"]) & (text_md5(docs) == gone["gone_md5"])
    return docs.join(gone, same, "left_anti").select(docs.columns)


SQL = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
ip AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM iw WHERE len(w) > 0),
ig AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM ip),
sizes AS (SELECT DISTINCT n FROM ig),
dp AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, sizes WHERE len(w) >= n),
dg AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM dp),
hits AS (SELECT doc_id, p, dg.n, item_id FROM dg JOIN ig ON dg.n = ig.n AND dg.g = ig.g),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered ON dw.doc_id = covered.doc_id LEFT JOIN listed ON dw.doc_id = listed.doc_id
"""
