"""Fuzzy line deduplication by MinHash.

A line's set holds the hashes of its distinct runs of ``k`` characters (A-Z
folded). Signatures come from one hash per shingle: the hash picks one of
``BANDS * ROWS`` bins and the smallest value of each bin is kept; an empty bin
borrows from another one in an order that is the same for all lines, so equal
places still agree with the Jaccard probability. With 10 bands of 4, a pair at
0.8 shares a band with probability 0.995 (somewhat less below 40 shingles, where
borrowed bins depend on each other), one at 0.9 with more than 0.9999.

Lines that share a band are confirmed by the exact Jaccard similarity of their
sets and joined by a distributed union-find (``neardup``, ``graph``). Of all
lines of a component, equal and similar, the first stays: smallest doc_id, then
smallest line number.

Equal lines are one id (XXH3, 64 bits over the raw bytes). A task signs each of
its lines once (again after ``SEEN`` others), and equal ids become one before
buckets are made, so a line that a third of all documents hold is signed once a
task and compared once. Line texts travel only to be compared: bands are made
where the documents are read, and a text leaves its task only if its id's bit
is set among those of the ids that share a bucket.

Defined cases: lines are what stands between line feeds; blank lines are
neither removed nor counted as copies; a line shorter than ``k`` has itself as
its one shingle. A null text has no lines, an empty one has one blank line.
Documents without a doc_id keep all lines. Rows that repeat a doc_id share its
line numbers: their equal lines stay together. An empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.arrays import (LOWER, NOT_SPACE, P_BYTE, U64, Slice, as_long, byte_values, mix, prefix_sums,
                                  run_mix, slices, text_array)
from turnstone.llm.neardup import different_buckets, near_components
from turnstone.llm.shared import row_name, stage, text_md5

SHINGLE = 8
NUM, DEN = 80, 100
BANDS, ROWS = 10, 4
BINS = BANDS * ROWS
#: pivots that an undecided line is laid against, per round of stars
STARS = (1, 4, 8)
#: buckets up to this size list their pairs, under the exact size and parity bounds
FEW = 32
#: bytes of the slices that shingles are made of, so that the arrays of 8 bytes a character stay in the processor's cache
CACHED = 1 << 16
#: ids of its lines that a task remembers at once
SEEN = 1 << 18
#: bits of the table of ids whose texts are read, 8 MB at most; ids that share a bit only let a text through to the join
WANTED = 1 << 26
FOLDED = byte_values(4)[LOWER]
_EMPTY = U64(0xFFFFFFFFFFFFFFFF)


class Lines:
    """Lines of a slice: byte ranges, text, number in the text, hash of the raw bytes."""

    def __init__(self, s: Slice):
        cut = np.flatnonzero(s.data == 10)
        # a line begins at each text and after each line feed; a text of n line feeds has n + 1 lines
        start = np.sort(np.concatenate([s.offsets[:-1], cut + 1]), kind="stable")
        end = np.sort(np.concatenate([s.offsets[1:], cut]), kind="stable")
        per = np.bincount(np.searchsorted(s.offsets, cut, side="right") - 1, minlength=s.n) + 1
        self.start, self.end = start, end
        self.doc = np.repeat(np.arange(s.n), per)
        self.number = np.arange(len(start)) - np.repeat(np.cumsum(per) - per, per)
        self.blank = np.ones(len(start), bool)
        some = np.flatnonzero(end > start)
        # a line's stretch runs to the next line and adds line feeds at most, which are white space
        self.blank[some] = ~np.logical_or.reduceat(NOT_SPACE[s.data], start[some]) if len(some) else True
        raw = memoryview(np.ascontiguousarray(s.data))
        self.hash = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())),
                                U64, len(start))


def _shingles(s: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-character runs of the texts of a slice, and the text each belongs to (in order)."""
    sums, inv = prefix_sums(FOLDED.take(s.data), P_BYTE)
    first = (s.data & 0xC0) != 0x80  # first bytes of characters
    ascii_ = first.all()
    if ascii_:
        edge = np.arange(len(s.data) + 1)
        begin, end, inv = s.offsets[:-1], s.offsets[1:], inv[:-1]
    else:
        at = np.flatnonzero(first)
        edge = np.append(at, len(s.data))
        begin, end = np.searchsorted(at, s.offsets[:-1]), np.searchsorted(at, s.offsets[1:])
        sums, inv = sums[edge], inv[at]
    n = end - begin
    h, keep = np.zeros(len(inv), U64), np.ones(len(inv), bool)
    m = max(len(inv) - k + 1, 0)
    np.subtract(sums[k:], sums[:m], out=h[:m])
    h[:m] *= inv[:m]
    for j in range(1, k):  # of a text's last k - 1 characters only a first one can begin a run
        keep[end[n > j] - j] = False
    if ascii_:
        h = run_mix(h[keep], np.array([k]))
    else:
        size = np.zeros(len(inv), np.int64)
        size[:m] = edge[k:] - edge[:m]
        h = run_mix(h[keep], size[keep])
    runs = np.maximum(n - k + 1, n > 0)
    short = np.flatnonzero((n > 0) & (n < k))
    a, b = begin[short], end[short]
    h[(np.cumsum(runs) - runs)[short]] = run_mix((sums[b] - sums[a]) * inv[a], edge[b] - edge[a])
    return h, np.repeat(np.arange(s.n), runs)


def signatures(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """One-permutation signatures with borrowed bins; every row must have a shingle.

    The shingle hashes are mixed already: their high half picks the bin, the hash itself is the value.
    """
    out = np.full(n * BINS, _EMPTY, U64)
    at = h >> U64(32)
    at *= U64(BINS)
    at >>= U64(32)
    at = as_long(at)
    at += row * BINS
    np.minimum.at(out, at, h)
    out = out.reshape(n, BINS)
    own = out != _EMPTY
    r, c = np.nonzero(~own)
    turn = 0
    while len(r):
        turn += 1
        other = (mix(np.arange(BINS, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(turn)) % U64(BINS)).astype(np.int64)[c]
        ok = own[r, other]
        out[r[ok], c[ok]] = out[r[ok], other[ok]]
        r, c = r[~ok], c[~ok]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), BANDS, ROWS)
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=U64)[None], len(sig), axis=0)
    for c in range(ROWS):
        keys = mix(keys * U64(0xD6E8FEB86659FD93) + parts[:, :, c])
    return keys


def line_sets(column, k: int):
    """The sorted distinct shingle hashes of each text of an Arrow column, each taken as one line."""
    for s in slices(column, CACHED):
        h, row = _shingles(s, k)
        cut = np.searchsorted(row, np.arange(s.n + 1))
        for i in range(s.n):
            x = np.sort(h[cut[i]:cut[i + 1]])
            new = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=new[1:])
            yield x[new]


def _distinct_lines(s: Slice, lines: Lines) -> np.ndarray:
    """One place for each different line of the slice that is not blank."""
    at = np.flatnonzero(~lines.blank)
    return at[np.unique(lines.hash[at], return_index=True)[1]]


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, numbers, hashes) per row; blank lines are left out of the two arrays."""

    def run(batches):
        for batch in batches:
            missing = np.asarray(text_array(batch).is_null().to_numpy(zero_copy_only=False))
            for s in slices(text_array(batch)):
                x = Lines(s)
                n = np.bincount(x.doc, minlength=s.n)
                n[missing[s.first:s.first + s.n]] = 0
                at = np.flatnonzero(~x.blank)
                cut = pa.array(np.searchsorted(x.doc[at], np.arange(s.n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.n), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(cut, pa.array(x.number[at], pa.int64())),
                     pa.ListArray.from_arrays(cut, pa.array(as_long(x.hash[at])))], ["doc_id", "n_lines", "numbers", "hashes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_lines bigint, numbers array<bigint>, hashes array<bigint>")


def _line_batches(batches, wanted: np.ndarray | None = None):
    """(id, text) of the different lines of the batches, of those whose bit is set in ``wanted`` if it is given."""
    seen: set = set()
    for batch in batches:
        for s in slices(text_array(batch)):
            x = Lines(s)
            at = _distinct_lines(s, x)
            if wanted is not None:
                bit = (x.hash[at] & U64(WANTED - 1)).astype(np.int64)
                at = at[wanted[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1]
            ids = x.hash[at].tolist()
            at = at[np.fromiter((i not in seen for i in ids), bool, len(ids))]
            if len(seen) > SEEN:
                seen.clear()
            seen.update(ids)
            if not len(at):
                continue
            text = [s.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(x.start[at], x.end[at])]
            yield pa.RecordBatch.from_arrays([pa.array(as_long(x.hash[at])), pa.array(text, pa.string())], ["id", "text"])


def _bands(docs: DataFrame, k: int) -> DataFrame:
    """(key, id) of the lines; a line that several tasks read stands several times."""

    def run(batches):
        for batch in _line_batches(batches):
            for s in slices(batch.column(1), CACHED):
                h, row = _shingles(s, k)
                keys = band_keys(signatures(h, row, s.n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(keys.ravel())), batch.column(0).slice(s.first, s.n).take(pa.array(np.repeat(np.arange(s.n), BANDS)))],
                    ["key", "id"])

    return docs.mapInArrow(run, "key bigint, id bigint")


def _shared(bands: DataFrame) -> DataFrame:
    """The distinct rows (key, id) whose key has several ids; sorted rows stream by, so one shuffle does and no key is held."""

    def run(batches):
        key = name = np.empty(0, np.int64)  # the last row, and whether the one before it has its key
        before = False
        for batch in batches:
            key, name = (np.concatenate([held, batch.column(i).to_numpy()]) for i, held in enumerate((key, name)))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
            key, name = key[new], name[new]
            if not len(key):
                continue
            same = key[1:] == key[:-1]
            left = np.concatenate([[before], same])
            several = left[:-1] | same
            yield pa.RecordBatch.from_arrays([pa.array(key[:-1][several]), pa.array(name[:-1][several])], ["key", "id"])
            key, name, before = key[-1:], name[-1:], left[-1]
        if before:
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(name)], ["key", "id"])

    return bands.repartition("key").sortWithinPartitions("key", "id").mapInArrow(run, "key bigint, id bigint")


def _id_bits(ids: DataFrame) -> np.ndarray:
    """Bytes of ``WANTED`` bits, those of the ids modulo ``WANTED`` set; one row of 4096 bytes per 32,768 of them."""
    bit = F.col("id").bitwiseAND(WANTED - 1) + 1
    rows = ids.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("bit")).repartition("bucket")
    out = np.zeros((WANTED >> 15, 4096), np.uint8)
    for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[r["bucket"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _line_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the lines of ``ids``, and of few others; a line that several tasks read stands several times."""
    bits = docs.sparkSession.sparkContext.broadcast(_id_bits(ids))
    return docs.mapInArrow(lambda batches: _line_batches(batches, bits.value), "id bigint, text string")


def find_repeated_lines(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed (line numbers from 0, ascending)."""
    narrow = docs.select(docs["doc_id"], docs["text"])
    named = narrow.where("doc_id IS NOT NULL")
    occ = stage(_occurrences(narrow), "lines")
    members = different_buckets(_shared(_bands(named, k)))

    def fetch(ids: DataFrame) -> DataFrame:
        return _line_texts(named, ids).join(ids, "id", "left_semi").groupBy("id").agg(F.first("text").alias("text"))

    comp = stage(near_components(members, fetch, lambda column: line_sets(column, k), num, den, stars=STARS, few=FEW), "components")
    rows = occ.where("doc_id IS NOT NULL").select("doc_id", F.explode(F.arrays_zip("numbers", "hashes")).alias("x")).select(
        "doc_id", F.col("x.numbers").alias("number"), F.col("x.hashes").alias("id"))
    # only lines that occur again, as themselves or in their component, can be removed
    first = stage(rows.groupBy("id").agg(F.min(F.struct("doc_id", "number")).alias("first"), F.count(F.lit(1)).alias("n"))
                  .join(comp, "id", "left").where("n > 1 OR component IS NOT NULL").select("id", "first", "n", F.coalesce("component", "id").alias("component")), "first")
    keep = first.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("total")).where("total > 1")
    keep = stage(first.join(keep, "component").select("id", "keep"), "keep")
    gone = (rows.join(keep, "id").where(F.struct("doc_id", "number") != F.col("keep"))
            .groupBy("doc_id").agg(F.array_sort(F.collect_set("number")).alias("removed")))
    out = occ.select("doc_id", "n_lines").join(gone, "doc_id", "left")
    removed = F.coalesce("removed", F.array().cast("array<bigint>"))
    return out.select("doc_id", "n_lines", F.size(removed).cast("bigint").alias("n_removed"), removed.alias("removed"))


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated lines cut from ``text``; its columns are kept.

    A row is named by doc_id and text, so a doc_id that repeats with another
    text loses only the lines that repeat; rows without a doc_id keep theirs.
    """
    named = docs.where(docs["doc_id"].isNotNull()).select(row_name(docs).alias("doc_id"), docs["text"])
    gone = find_repeated_lines(named, **options).where("n_removed > 0").select(
        F.col("doc_id.doc_id").alias("gone_id"), F.col("doc_id.text_md5").alias("gone_md5"),
        F.col("removed").alias("gone_lines")).dropDuplicates(["gone_id", "gone_md5"])
    same = (docs["doc_id"] == gone["gone_id"]) & (text_md5(docs) == gone["gone_md5"])
    kept = F.array_join(F.filter(F.split(docs["text"], "\n"), lambda x, i: ~F.array_contains(gone["gone_lines"], i.cast("bigint"))), "\n")
    text = F.when(gone["gone_lines"].isNull(), docs["text"]).otherwise(kept)
    return docs.join(gone, same, "left").select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
