"""Target-distribution importance resampling over hashed n-grams.

A text is lower-cased (A-Z), its separators are collapsed to single spaces, and
one ``regex`` scan per n-gram size with ``overlapped=True`` emits the n-gram
spans: the left boundary is a space kept out of the match, the right one a
look-ahead. Every distinct span of a document is counted once by CRC-32 into a
bucket. The corpus, and the target texts, are two count vectors over the
buckets; a document's weight is the sum of its features' log ratios.

1. One scan turns each text into its buckets and counts, staged as two packed
   columns; texts are not read again.
2. The bucket counts of the corpus are summed per input partition (at most
   ``buckets`` rows each) and then over all; ``buckets`` numbers come to the
   driver and go back as the gains.
3. Weight and Gumbel noise, taken from the seed and the doc_id, give the score.
   The highest scores are drawn without replacement: eligible rows are range
   partitioned by score, so no task ranks more than its range.

Defined cases: a null or empty text has no features and weight 0; a row without
a doc_id has no noise, hence no score, and is neither counted nor drawn; equal
scores go by doc_id, rows that repeat a doc_id by features, weight and input
place. Rows are never dropped. An empty table gives an empty result; empty
targets leave all gains to the corpus. Texts of any length are scanned whole.
Further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.arrays import text_array
from turnstone.llm.shared import stage
from turnstone.operators.prefix import running_totals

BUCKETS = 10_000
SIZES = (1, 1)
SEED = 2024
MIN_WORDS = 20
SHARE = 10

#: A-Z folded; every byte that is not of a word becomes a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def scanner(n: int):
    """A function that gives all runs of ``n`` consecutive words of a collapsed text, as match objects."""
    find = regex.compile(rb" \K[^ ]++(?: [^ ]++){%d}(?= )" % (n - 1)).finditer
    return lambda text: find(text, overlapped=True)


def collapse(text: bytes) -> bytes:
    """Words in lower case, with one space around each."""
    return b" " + b" ".join(text.translate(_FOLD).split()) + b" "


def _features(docs: DataFrame, sizes: tuple[int, int], buckets: int) -> DataFrame:
    """(doc_id, place, n_words, n_features, bucket, times): the distinct buckets of a row, packed as 32-bit numbers."""

    def run(batches):
        scan = [scanner(n) for n in range(sizes[0], sizes[1] + 1)]
        for batch in batches:
            words, total, at, times = [], [], [], []
            for text in text_array(batch).cast(pa.binary()):
                flat = collapse(text.as_py() or b"")
                spans: Counter = Counter()
                for found in scan:
                    spans.update(m.group() for m in found(flat))
                b = np.fromiter((zlib.crc32(g) % buckets for g in spans), np.int32, len(spans))
                n = np.fromiter(spans.values(), np.int64, len(spans))
                b, row = np.unique(b, return_inverse=True)
                n = np.bincount(row, n, len(b)).astype(np.int64)
                words.append(flat.count(b" ") - 1 if len(flat) > 2 else 0)
                total.append(int(n.sum()))
                at.append(b.astype("<i4").tobytes())
                times.append(n.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(words, pa.int64()), pa.array(total, pa.int64()),
                 pa.array(at, pa.binary()), pa.array(times, pa.binary())],
                ["doc_id", "place", "n_words", "n_features", "bucket", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select(docs["doc_id"], docs["text"], F.monotonically_increasing_id().alias("place"))
    return narrow.mapInArrow(run, f"doc_id {kind}, place bigint, n_words bigint, n_features bigint, "
                                  "bucket binary, times binary")


def _packed(column) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a packed column, and where each row's begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // 4
    data = column.buffers()[2]
    numbers = np.frombuffer(data, "<i4", count=len(data) // 4) if data is not None else np.empty(0, np.int32)
    return numbers[offsets[0]:offsets[-1]], offsets - offsets[0]


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs over all rows."""

    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            if batch.num_rows:
                sums += np.bincount(_packed(batch.column(0))[0], _packed(batch.column(1))[0], buckets).astype(np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    summed = features.select("bucket", "times").mapInArrow(run, "bucket bigint, n bigint")
    for r in summed.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of target and corpus frequency per bucket, smoothed by one, in whole thousandths (rounded down)."""
    n, big_s, big_t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (big_s + n)) / ((s + 1.0) * (big_t + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weights(features: DataFrame, gain: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at, first = _packed(batch.column(4))
            sums = np.concatenate([[0], np.cumsum(gain[at] * _packed(batch.column(5))[0])])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums[first[1:]] - sums[first[:-1]], pa.int64())],
                                             ["doc_id", "place", "n_words", "n_features", "weight"])

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.mapInArrow(run, f"doc_id {kind}, place bigint, n_words bigint, n_features bigint, weight bigint")


def _noise(seed: int):
    """Gumbel noise in thousandths from the seed and the doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, sizes: tuple[int, int] = SIZES,
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank, n_words; rank counts the drawn rows from 1.

    ``share`` percent of the documents with at least ``min_words`` words are drawn.
    """
    f = stage(_features(docs, sizes, buckets), "features")
    wanted = _features(target.select(F.lit(0).alias("doc_id"), target["text"]), sizes, buckets)
    gain = gains(bucket_counts(f, buckets), bucket_counts(wanted, buckets))
    scored = stage(_weights(f, gain).withColumn("score", F.col("weight") + _noise(seed)), "scores")
    eligible = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    drawn = scored.where(eligible).count() * share // 100
    order = ["doc_id", "n_features", "weight", "place"]
    ranked = running_totals(scored.where(eligible).withColumn("one", F.lit(1).cast("bigint")), "score", ["one"],
                            descending=True, tiebreak=order)
    rank = F.when(F.col("cum_one") <= drawn, F.col("cum_one"))
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, rank.alias("rank"), "n_words").unionByName(
        scored.where(~F.coalesce(eligible, F.lit(False))).select(*out, F.lit(None).cast("bigint").alias("rank"), "n_words"))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns; a doc_id that repeats is drawn as a whole."""
    ids = resample(docs, target, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("drawn_id")).distinct()
    return docs.join(ids, docs["doc_id"] == ids["drawn_id"], "left_semi").select(docs.columns)


_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({0}))),
  lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))))"""
_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

SQL = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dx AS (SELECT doc_id, unnest(w) AS g FROM dw),
bx AS (SELECT unnest({_WORDS}) AS g FROM benchmark),
vocab AS (SELECT g, {_CRC.format('g')} % 10000 AS bucket FROM (SELECT g FROM dx UNION SELECT g FROM bx)),
s AS (SELECT bucket, count(*) AS n FROM dx JOIN vocab USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bx JOIN vocab USING (g) GROUP BY bucket),
gain AS (SELECT b.bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM vocab) b LEFT JOIN s ON b.bucket = s.bucket LEFT JOIN t ON b.bucket = t.bucket),
wt AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM dx JOIN vocab USING (g) JOIN gain USING (bucket) GROUP BY doc_id),
sc AS (SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || dw.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296::DOUBLE))) AS BIGINT) AS score, CAST(len(w) AS BIGINT) AS n_words FROM dw LEFT JOIN wt ON dw.doc_id = wt.doc_id),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM sc WHERE n_words >= 20)
SELECT sc.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank, n_words
FROM sc LEFT JOIN rk ON sc.doc_id = rk.doc_id
"""
