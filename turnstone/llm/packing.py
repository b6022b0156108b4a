"""Packing documents into token sequences by cutting-stock column generation.

1. One scan tokenises whole texts (Arrow batches) and stages, per document, its
   number of tokens and the checksum of each piece: full pieces of ``capacity``
   tokens and one remainder. No tokens are stored.
2. The histogram of remainder lengths, in classes of ``step`` tokens (at most
   ``capacity / step`` rows), goes to the driver; ``column_generation`` turns it
   into patterns and their uses.
3. Documents are ranked within their class. A class may hold a third of all
   documents, so ranks are made within (class, bucket) and shifted by the
   counts of the buckets before; the number of buckets follows the row count.
4. The patterns give, per class, a few segments of ranks; a document finds its
   sequence and its slot there by arithmetic. Segments are at most the
   non-zeros of the basis, a bound that does not depend on the data, so they
   are broadcast. Offsets are a running sum over the pieces of a sequence.

Lengths count as rounded up to ``step`` in the program, so a sequence has about
``step / 2`` tokens of padding per piece, and little else.

Token ids are those of the ``tokenizers`` file, which is the only vocabulary
read; its merges are run by ``tiktoken`` (the same byte-level merges, several
times faster), once per distinct chunk between single spaces. A text that
holds a special token's string goes through ``tokenizers`` itself.

Defined cases: a null or empty text is one end-of-document id. Rows that repeat
a doc_id or are null there are packed like any other row. Further columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from turnstone.llm.column_generation import whole_patterns
from turnstone.llm.shared import stage

CAPACITY = 1024
END = 0
STEP = 8
BUCKET_ROWS = 20_000
CACHE = 1_000_000
#: code points without a single space between words from which the vocabulary's own library takes over: a run of some
#: 700,000 white-space characters overflows the other one's stack
LONG = 100_000

#: the published split pattern of this vocabulary (fixed value)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class TokenIds:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: bytes):
        import tiktoken
        spec = json.loads(vocabulary)
        self.json = vocabulary
        self.special = [t["content"] for t in spec["added_tokens"]]
        # byte-level files spell bytes as printable characters: the printable ones as themselves, the rest from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        char = {chr(b): b for b in plain}
        char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(char[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced: dict[str, bytes] = {}
        self.slow = None
        self.uneven = re.compile(r"\s\s")
        self.single = re.compile(r"(?<=\S) (?=\S)")

    def _own(self, text: str) -> bytes:
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_buffer(self.json)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, text: str) -> bytes:
        if len(text) > LONG:
            return self._own(text)
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._own(text)
        # a space between two non-space characters always begins a new pre-token
        head, *rest = self.single.split(text) if self.uneven.search(text) else text.split(" ")
        have = self.spaced
        try:
            tail = b"".join(map(have.__getitem__, rest))
        except KeyError:
            if len(have) > CACHE:  # bounds the memory of a worker
                have.clear()
            own = {}
            for c in rest:
                if c not in have:
                    b = self._chunk(" " + c)
                    if len(c) <= 64:
                        have[c] = b
                    else:
                        own[c] = b
            tail = b"".join(have[c] if c in have else own[c] for c in rest)
        return self._chunk(head) + tail


_made: dict[int, TokenIds] = {}


def _pieces(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """(doc_id, n_tokens, rest, crcs): crcs of the full pieces, then of the remainder if there is one."""
    with open(vocabulary, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        ids_of = _made.get(0) or _made.setdefault(0, TokenIds(spec.value))
        if ids_of.json != spec.value:
            ids_of = _made[0] = TokenIds(spec.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                n, crcs = [], []
                for t in part.column(1):
                    b = ids_of(t.as_py() or "") + end
                    n.append(len(b) // 4)
                    crcs.append([zlib.crc32(b[a:a + 4 * capacity]) for a in range(0, len(b), 4 * capacity)])
                n = np.array(n, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(n % capacity), pa.array(crcs, pa.list_(pa.int64()))],
                    ["doc_id", "n_tokens", "rest", "crcs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, rest bigint, crcs array<bigint>")


def _segments(classes, uses):
    """Rows (class, [(rank, copies, sequence, slot)]): documents of that class from ``rank`` on lie ``copies``
    to a sequence, from ``sequence`` on, the first of them in ``slot``; and the number of sequences."""
    rank = np.zeros(len(classes), np.int64)
    out: dict[int, list] = {}
    sequence = 0
    for counts, n in uses:
        slot = 0
        for i in np.flatnonzero(counts)[::-1]:
            c = int(counts[i])
            out.setdefault(int(classes[i]), []).append((int(rank[i]), c, sequence, slot))
            rank[i] += n * c
            slot += c
        sequence += n
    return [(k, v) for k, v in out.items()], sequence


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, step: int = STEP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    p = stage(_pieces(docs, vocabulary or default_vocabulary(), capacity), "pieces")
    n_buckets = max(1, -(-p.count() // BUCKET_ROWS))
    p = (p.withColumn("class", F.ceil(F.col("rest") / step).cast("bigint"))
         .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "crcs"), F.lit(n_buckets)))
         .withColumn("own_full", F.size("crcs") - (F.col("rest") > 0).cast("int")))
    counts = stage(p.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("own_full").alias("n_full")), "counts")
    totals = {r["class"]: (r["n"], r["n_full"]) for r in counts.groupBy("class").agg(
        F.sum("n").alias("n"), F.sum("n_full").alias("n_full")).collect()}  # at most capacity / step rows
    classes = np.array(sorted(k for k in totals if k), np.int64)
    demand = np.array([totals[k][0] for k in classes], np.int64)
    rows, base = _segments(classes, whole_patterns(classes, demand, capacity // step))
    bases = []
    for k in sorted(totals):
        bases.append((int(k), base))
        base += totals[k][1]
    segments = spark.createDataFrame(
        rows, "class bigint, segments array<struct<rank:bigint, copies:bigint, sequence:bigint, slot:bigint>>")
    first_full = spark.createDataFrame(bases, "class bigint, base bigint")

    before = W.partitionBy("class").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"),
                           F.coalesce(F.sum("n_full").over(before), F.lit(0)).alias("full_before"))
    inside = W.partitionBy("class", "bucket").orderBy("doc_id", "crcs")
    ranked = (p.withColumn("r", F.row_number().over(inside) - 1)
              .withColumn("f", F.sum("own_full").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("own_full"))
              .join(shifts, ["class", "bucket"])
              .join(F.broadcast(first_full), "class")
              .withColumn("rank", F.col("r") + F.col("ranks_before")))
    ranked = stage(ranked.select("doc_id", "n_tokens", "rest", "crcs", "class", "own_full", "rank",
                                 (F.col("base") + F.col("full_before") + F.col("f")).alias("first_full")), "ranked")
    tails = (ranked.where("rest > 0").join(F.broadcast(segments), "class")
             .withColumn("seg", F.expr("element_at(filter(segments, s -> s.rank <= rank), -1)"))
             .withColumn("place", F.col("rank") - F.col("seg.rank"))
             .select("doc_id", (F.col("n_tokens") - F.col("rest")).alias("start"), F.col("rest").alias("length"),
                     F.element_at("crcs", -1).alias("ids_crc32"), F.col("n_tokens").alias("doc_tokens"),
                     (F.col("seg.sequence") + F.floor(F.col("place") / F.col("seg.copies"))).alias("sequence_id"),
                     (F.col("seg.slot") + F.col("place") % F.col("seg.copies")).alias("slot")))
    upto = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, 0)
    tails = tails.withColumn("offset", F.sum("length").over(upto) - F.col("length")).drop("slot")
    fulls = (ranked.where("own_full > 0")
             .select("doc_id", "n_tokens", "first_full", F.posexplode(F.slice("crcs", 1, F.col("own_full"))).alias("i", "crc"))
             .select("doc_id", (F.col("i") * capacity).cast("bigint").alias("start"),
                     F.lit(capacity).cast("bigint").alias("length"), F.col("crc").alias("ids_crc32"),
                     F.col("n_tokens").alias("doc_tokens"), (F.col("first_full") + F.col("i")).alias("sequence_id"),
                     F.lit(0).cast("bigint").alias("offset")))
    return tails.unionByName(fulls)
