"""MinHash near-duplicate detection with min-max hashing.

A document's set holds the hashes of its distinct runs of ``k`` words (A-Z
folded, words are runs without white space). Under each permutation both the
smallest and the largest value of the set are kept: each agrees between two
sets with probability equal to their Jaccard similarity, so one hash
evaluation gives two signature values, and the estimate from both has a lower
variance than from minima alone. Minima and maxima are banded; ids that share
a band are candidates, and ``neardup`` confirms links on the full sets.

With 80 permutations and bands of 5 there are 32 bands: a pair at 0.8 is missed
with probability 3e-6, one at 0.85 with 7e-9.

Equal sets are collapsed first (a 128-bit digest of the set, smallest doc_id
stands for all), so a third of all documents being copies is one row here.

Defined cases: a text with fewer than ``k`` words, but not none, has its whole
word sequence as its one shingle; a text without words, or null, has an empty
set and is linked with nothing. A null doc_id has component null and stays.
Rows that repeat a doc_id are judged by their own texts and share that id's
place in the link graph. An empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm.arrays import (LOWER, NOT_SPACE, U64, Words, as_long, grams, mix, run_hash, prefix_sums, P_WORD,
                                  slices, text_array)
from turnstone.llm.neardup import near_components, shared_keys
from turnstone.llm.shared import stage, text_md5
from turnstone.operators.prefix import running_totals

SHINGLE = 4
NUM, DEN = 80, 100
PERMUTATIONS = 80
BAND = 5
SEED = 20_011


def shingle_sets(column, k: int):
    """The sorted distinct shingle hashes of each text of an Arrow column."""
    for s in slices(column):
        w = Words(s, NOT_SPACE, LOWER)
        h, at = grams(w.hash, w.doc, k)
        bound = np.searchsorted(w.doc[at], np.arange(s.n + 1))
        short = None
        for i in range(s.n):
            a, b = bound[i], bound[i + 1]
            if b > a:
                yield np.unique(h[a:b])
                continue
            f, g = w.first[i:i + 1], w.first[i + 1:i + 2]
            if g[0] > f[0]:
                short = prefix_sums(w.hash, P_WORD) if short is None else short
                yield run_hash(short, f, g)
            else:
                yield np.empty(0, U64)


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(SEED))
    return x[:n], x[n:] | U64(1)


def signatures(sets: list[np.ndarray], permutations: int = PERMUTATIONS) -> np.ndarray:
    """One row per set (none may be empty): all minima, then all maxima."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2 * permutations), U64)
    for i, (x, m) in enumerate(zip(*_permutations(permutations))):
        v = (flat ^ x) * m
        out[:, i] = np.minimum.reduceat(v, at)
        out[:, permutations + i] = np.maximum.reduceat(v, at)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity estimate of two signatures."""
    return float((a == b).mean())


def band_keys(sig: np.ndarray, band: int = BAND) -> np.ndarray:
    """Hash of each run of ``band`` values; the band's number is part of it."""
    n = sig.shape[1] // band
    keys = np.empty((len(sig), n), U64)
    for j in range(n):
        acc = np.full(len(sig), j + 1, U64)
        for c in range(j * band, (j + 1) * band):
            acc = mix(acc * U64(0xD6E8FEB86659FD93) + sig[:, c])
        keys[:, j] = acc
    return keys


def _features(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, d1, d2, keys) per row; d1 and d2 are the digest of the set, keys is null for an empty set."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            row, sets = 0, []

            def out():
                full = [s for s in sets if len(s)]
                n = np.array([len(s) for s in sets], np.int64)
                d = np.zeros((2, len(sets)), U64)
                if full:
                    flat = np.concatenate(full)
                    at = np.concatenate([[0], np.cumsum([len(s) for s in full])[:-1]])
                    d[0, n > 0] = np.add.reduceat(mix(flat + U64(0x1234567)), at)
                    d[1, n > 0] = np.add.reduceat(mix(flat ^ U64(0xABCDEF0123456789)), at)
                    keys = iter(as_long(band_keys(signatures(full))))
                lists = pa.array([next(keys) if x else None for x in n], pa.list_(pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [ids.slice(row - len(sets), len(sets)), pa.array(n), pa.array(as_long(d[0])), pa.array(as_long(d[1])),
                     lists], ["doc_id", "n", "d1", "d2", "keys"])

            size = 0
            for s in shingle_sets(batch.column(1), k):
                sets.append(s)
                row += 1
                size += len(s)
                if size > 200_000 or len(sets) >= 4096:
                    yield out()
                    sets, size = [], 0
            if sets:
                yield out()

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n bigint, d1 bigint, d2 bigint, keys array<bigint>")


def minmax_dedup(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    f = stage(_features(docs, k), "features")
    some = f.where("n > 0 AND doc_id IS NOT NULL")
    reps = stage(some.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "reps")
    first = some.join(reps.select("d1", "d2", "n", F.col("rep").alias("doc_id")), ["d1", "d2", "n", "doc_id"], "left_semi")
    bands = stage(first.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id")).distinct(), "bands")

    def fetch(ids: DataFrame) -> DataFrame:
        return docs.select(docs["doc_id"].alias("id"), docs["text"]).join(ids, "id", "left_semi")

    comp = stage(near_components(shared_keys(bands), fetch, lambda column: shingle_sets(column, k), num, den), "components")
    moved = stage(reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
                  .select("d1", "d2", "n", F.coalesce("component", "rep").alias("component_id")), "moved")
    placed = f.select("doc_id", "n", "d1", "d2").join(moved, ["d1", "d2", "n"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    placed = placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _distinct_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, own): one id per different text; ``own`` is the doc_id, or a new one above all doc_ids for the
    second and further texts of a repeated doc_id, in the order of their digests."""
    named = stage(docs.where(docs["doc_id"].isNotNull()).select(docs["doc_id"], text_md5(docs).alias("text_md5")), "names")
    first = named.groupBy("doc_id").agg(F.min("text_md5").alias("first_md5"), F.max("text_md5").alias("last_md5"))
    several = stage(first.where("first_md5 <> last_md5").select("doc_id", "first_md5"), "several")
    if several.isEmpty():
        return docs.select(docs["doc_id"], docs["text"], docs["doc_id"].alias("own"))
    extra = named.join(several, "doc_id").where("text_md5 <> first_md5").select(
        F.col("doc_id").alias("extra_id"), F.col("text_md5").alias("extra_md5"), F.lit(1).cast("bigint").alias("one")).distinct()
    top = named.agg(F.max("doc_id")).first()[0]
    extra = stage(running_totals(extra, "extra_id", ["one"], tiebreak=["extra_md5"]).select(
        "extra_id", "extra_md5", (F.col("cum_one") + top).alias("new_id")), "extra")
    same = (docs["doc_id"] == extra["extra_id"]) & (text_md5(docs) == extra["extra_md5"])
    return docs.join(extra, same, "left").select(docs["doc_id"], docs["text"], F.coalesce("new_id", docs["doc_id"]).alias("own"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document per component; its columns are kept. Rows without a doc_id stay.

    Texts are judged one by one, also where a doc_id repeats with another text;
    rows that repeat doc_id and text stay or go together.
    """
    rows = _distinct_rows(docs)
    found = minmax_dedup(rows.select(F.col("own").alias("doc_id"), "text"), **options)
    lost = found.where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("own")).distinct()
    gone = stage(rows.join(lost, "own", "left_semi").select(
        F.col("doc_id").alias("gone_id"), text_md5(rows).alias("gone_md5")).distinct(), "gone")
    same = (docs["doc_id"] == gone["gone_id"]) & (text_md5(docs) == gone["gone_md5"])
    return docs.join(gone, same, "left_anti").select(docs.columns)


SQL = """
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sp AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM dw WHERE len(w) > 0),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 3], ' ')) AS g FROM sp),
sz AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
cp AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
ln AS MATERIALIZED (SELECT a, b FROM cp JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
lk AS MATERIALIZED (SELECT a AS u, b AS v FROM ln UNION ALL SELECT b, a FROM ln),
reach AS (SELECT doc_id AS root, doc_id AS id FROM dw UNION SELECT reach.root, lk.v FROM reach JOIN lk ON reach.id = lk.u),
comp AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT dw.doc_id, coalesce(sz.n, 0) AS n_shingles, comp.component_id, dw.doc_id = comp.component_id AS kept
FROM dw JOIN comp ON dw.doc_id = comp.id LEFT JOIN sz ON sz.doc_id = dw.doc_id
"""
