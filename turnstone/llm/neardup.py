"""From band keys to verified components, for any kind of set.

A bucket is all ids that share a band key. Instead of all pairs of a bucket,
rounds of stars are compared (``STARS``; the first two join the bulk of a group):

1. Every bucket that still holds ids of several components has one pivot, a
   random member of its largest component; every id outside that component is
   laid against one pivot, and the Jaccard similarity of the full sets decides.
   Confirmed links join components, and the next round takes other pivots. A
   round costs one comparison per undecided id, or as many as ``stars`` names
   for it, each with another member of the largest component.
2. What is still undecided after the rounds, or when a round finds
   nothing, is paired. Buckets of at most ``FEW`` ids (chance collisions) give
   their pairs directly, one or two per id. Larger ones go through an exact
   prefix filter: shingles are ordered from rare
   to common, and two sets can only reach the threshold if they share one of
   their first few, at positions that leave room for the needed overlap, and if
   the 512-bit parity maps of the sets differ in few enough bits (the maps never
   differ in more bits than the sets do in shingles).
   Members of a group that differ too much from all others are told apart by
   their own rare shingles, without being compared. Pairs that pass are
   compared; pairs within a component cannot change the result, so no link
   between components is missed.

Ids and keys travel as longs; texts are joined only for ids that share a
bucket with another id, and sets are made from the texts where they are
compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from turnstone.llm.graph import components
from turnstone.llm.shared import stage

Sets = Callable[[pa.Array], Iterator[np.ndarray]]
ROWS = 256
STARS = (1, 1)
FEW = 4
MAP = 512
MAP_NAMES = [f"b{k}" for k in range(MAP // 64)]


def _verify(pairs: DataFrame, texts: DataFrame, sets_of: Sets, num: int, den: int) -> DataFrame:
    """Pairs (u, v) whose sets have num/den of their union in common."""
    both = (pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u")
            .join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v")
            .select("u", "v", "text_u", "text_v"))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                v = part.column(1)
                mine = list(sets_of(part.column(2)))
                # a pivot meets many rows of a batch: make each of its sets once
                first: dict = {}
                at = [first.setdefault((p, hash(t)), n) for n, (p, t) in
                      enumerate(zip(v.to_pylist(), part.column(3).to_pylist()))]
                need = sorted(set(first.values()))
                made = dict(zip(need, sets_of(part.column(3).take(pa.array(need, pa.int64())))))
                ok = []
                for a, k in zip(mine, at):
                    b = made[k]
                    if min(len(a), len(b)) * den < num * max(len(a), len(b)):
                        ok.append(False)
                        continue
                    inter = len(np.intersect1d(a, b, assume_unique=True))
                    ok.append(inter > 0 and inter * den >= num * (len(a) + len(b) - inter))
                keep = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), v.filter(keep)], ["u", "v"])

    return both.mapInArrow(run, "u bigint, v bigint")


def shared_keys(bands: DataFrame) -> DataFrame:
    """The rows (key, id) of ``bands`` whose key has several ids; ``bands`` is read twice, so staged by the caller."""
    several = stage(bands.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
                    .where("low < high").select("key"), "buckets")
    return bands.join(several, "key", "left_semi")


def different_buckets(members: DataFrame) -> DataFrame:
    """``members`` (key, id) without buckets that hold the same ids as another one; ``members`` is staged here.

    Buckets are the same when size, smallest and largest id and two 64-bit xors of hashed ids agree.
    """
    members = stage(members, "members")
    per = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    one = stage(per.groupBy("n", "low", "high", "x", "y").agg(F.min("key").alias("key")).select("key"), "different")
    return members.join(one, "key", "left_semi")


def near_components(members: DataFrame, fetch: Callable[[DataFrame], DataFrame], sets_of: Sets,
                    num: int, den: int, stars: tuple[int, ...] = STARS, few: int = FEW) -> DataFrame:
    """(id, component) of all ids that share a key with another; component is the smallest id reachable.

    ``members``: distinct (key, id) of the keys with several ids. ``fetch`` gives (id, text) for a table of ids.
    ``stars``: for each round, how many pivots an undecided id is laid against. ``few``: buckets up to this size give
    their pairs directly; with more than ``FEW``, sizes and parity maps are tested in that join, and only larger
    buckets go through the rounds after the first. The result is the same for all.
    """
    place = stage(members.select("key", "id", F.col("id").alias("c")), "place")
    comp = stage(place.select("id").distinct().withColumn("component", F.col("id")), "component")
    texts = stage(fetch(comp.select("id")), "texts")
    tested = aside = None
    for turn, pivots in enumerate(stars):
        rays = _stars(place, turn, pivots)
        if tested is not None:
            rays = rays.join(tested, ["u", "v"], "left_anti")
        rays = stage(rays, "stars")
        tested = rays.select("u", "v") if tested is None else tested.unionByName(rays.select("u", "v"))
        links = stage(_verify(rays.select("u", "v"), texts, sets_of, num, den).join(rays, ["u", "v"]), "verified")
        moved = stage(components(links, "cu", "cv"), "moved")
        if not moved.limit(1).count():
            break
        comp = stage(_relabel(comp, "component", moved), "component")
        place = _undecided(_relabel(place, "c", moved))
        if few > FEW and aside is None:
            sizes = stage(place.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "sizes")
            aside = place.join(sizes.where(F.col("size") <= few).select("key"), "key", "left_semi").select("key", "id")
            place = stage(place.join(sizes.where(F.col("size") > few).select("key"), "key", "left_semi"), "place")
    if aside is not None:
        place = place.unionByName(aside.join(comp.withColumnRenamed("component", "c"), "id"))
    sized = stage(place.withColumn("size", F.count(F.lit(1)).over(W.partitionBy("key"))), "sized")
    small, large = sized.where(F.col("size") <= few), sized.where(F.col("size") > few)
    listed = _few_pairs(small) if few <= FEW else _mapped_pairs(small, texts, sets_of, num, den)
    pairs = listed.unionByName(_cross_pairs(large, texts, sets_of, num, den)).distinct()
    if tested is not None:
        both = tested.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        pairs = pairs.join(both, ["u", "v"], "left_anti")
    pairs = stage(pairs, "pairs")
    more = stage(_verify(pairs.select("u", "v"), texts, sets_of, num, den).join(pairs, ["u", "v"]), "verified")
    return _relabel(comp, "component", components(more, "cu", "cv"))


def _relabel(df: DataFrame, name: str, moved: DataFrame) -> DataFrame:
    """``df`` with the component in ``name`` replaced where ``moved`` (id, component) has a new one."""
    new = moved.select(F.col("id").alias(name), F.col("component").alias("new_label"))
    rest = [c for c in df.columns if c != name]
    return df.join(new, name, "left").select(*rest, F.coalesce("new_label", name).alias(name))


def _undecided(place: DataFrame) -> DataFrame:
    """Only the buckets that still hold several components."""
    place = stage(place, "place")
    split = stage(place.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"))
                  .where("low < high").select("key"), "split")
    return stage(place.join(split, "key", "left_semi"), "place")


def _stars(place: DataFrame, turn: int, pivots: int = 1) -> DataFrame:
    """(u, v, cu, cv): every id outside the largest component of its buckets, against ``pivots`` of its members at most."""
    if turn:
        size = stage(place.select("id", "c").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("m")), "sizes")
        sized = stage(place.join(size, "c"), "sized")
    else:  # every id is its own component yet
        sized = place.withColumn("m", F.lit(1).cast("bigint"))
    draws = [F.lit(turn)] if pivots == 1 else [F.lit(f"{turn}.{j}") for j in range(pivots)]
    found = sized.groupBy("key").agg(*[F.max(F.struct("m", F.xxhash64("id", d).alias("h"), "id", "c")).alias(f"p{j}")
                                       for j, d in enumerate(draws)])
    if pivots == 1:
        found = found.select("key", F.lit(0).alias("draw"), F.col("p0").alias("p"))
    else:
        found = found.select("key", F.posexplode(F.array(*[f"p{j}" for j in range(pivots)])).alias("draw", "p"))
    pivot = stage(found.select("key", "draw", F.col("p.id").alias("v"), F.col("p.c").alias("cv"), F.col("p.m").alias("mv"),
                               F.col("p.h").alias("h")), "pivots")
    near = (sized.join(pivot, "key").where("c <> cv").groupBy("id", "c", "draw", "v", "cv", "mv", "h")
            .agg(F.count(F.lit(1)).alias("shared")))
    best = near.groupBy("id", "c", "draw").agg(F.max(F.struct("mv", "shared", "h", "v", "cv")).alias("b"))
    rays = best.select(F.col("id").alias("u"), F.col("b.v").alias("v"), F.col("c").alias("cu"), F.col("b.cv").alias("cv"))
    return rays if pivots == 1 else rays.distinct()


def _ordered_pair():
    return [F.greatest("l.id", "r.id").alias("u"), F.least("l.id", "r.id").alias("v"),
            F.least("l.c", "r.c").alias("cu"), F.greatest("l.c", "r.c").alias("cv")]


def _few_pairs(place: DataFrame) -> DataFrame:
    """(u, v, cu, cv): all pairs of different components in buckets of a fixed small size."""
    l, r = place.alias("l"), place.alias("r")
    return l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.c") < F.col("r.c"))).select(*_ordered_pair())


def _parity_maps(ids: DataFrame, sets_of: Sets) -> DataFrame:
    """(id, n, b0..b7): set size and 512-bit parity map of (id, text)."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                sets = list(sets_of(part.column(1)))
                bits = np.stack([np.bincount((x >> np.uint64(20) & np.uint64(MAP - 1)).astype(np.int64), minlength=MAP) & 1
                                 for x in sets]).astype(np.uint8)
                words = np.packbits(bits, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in sets], pa.int64()),
                     *(pa.array(np.ascontiguousarray(words[:, k])) for k in range(MAP // 64))], ["id", "n", *MAP_NAMES])

    return ids.select("id", "text").mapInArrow(run, "id bigint, n bigint, " + ", ".join(f"{b} bigint" for b in MAP_NAMES))


def _can_reach(num: int, den: int):
    """Whether sizes and parity maps of the rows ``l`` and ``r`` leave room for num/den."""
    differ = sum(F.bit_count(F.col(f"l.{b}").bitwiseXOR(F.col(f"r.{b}"))) for b in MAP_NAMES)
    return ((F.col("l.n") * den >= F.col("r.n") * num) & (F.col("r.n") * den >= F.col("l.n") * num)
            & (differ * (num + den) <= (F.col("l.n") + F.col("r.n")) * (den - num)))


def _mapped_pairs(place: DataFrame, texts: DataFrame, sets_of: Sets, num: int, den: int) -> DataFrame:
    """(u, v, cu, cv): the pairs of ``_few_pairs`` that can reach num/den."""
    ids = texts.join(place.select("id").distinct(), "id", "left_semi")
    mapped = stage(place.select("key", "id", "c").join(_parity_maps(ids, sets_of), "id"), "mapped")
    l, r = mapped.alias("l"), mapped.alias("r")
    return l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.c") < F.col("r.c")) & _can_reach(num, den)).select(*_ordered_pair())


def _cross_pairs(place: DataFrame, texts: DataFrame, sets_of: Sets, num: int, den: int) -> DataFrame:
    """(u, v, cu, cv): all pairs of different components that can reach num/den, by prefix and position."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                sets = list(sets_of(part.column(2)))
                size = np.array([len(x) for x in sets], np.int64)
                at = pa.array(np.repeat(np.arange(len(sets)), size))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(np.repeat(size, size)),
                     pa.array(np.concatenate(sets).view(np.int64))], ["id", "c", "n", "g"])

    ids = stage(place.select("id", "c").distinct().join(texts, "id").select("id", "c", "text"), "undecided")
    rows = ids.mapInArrow(run, "id bigint, c bigint, n bigint, g bigint")
    common = stage(rows.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "common")
    mine = W.partitionBy("id")
    rows = rows.join(common, "g").select(
        "id", "c", "n", "g", (F.col("n") - F.count(F.lit(1)).over(mine) + F.row_number().over(mine.orderBy("df", "g")) - 1)
        .alias("p"))  # place in the order from rare to common; shingles of one set only come first
    parity = _parity_maps(ids, sets_of).drop("n")
    prefix = stage(rows.where(F.col("p") <= F.col("n") - F.ceil(F.col("n") * num / den)).join(parity, "id"), "prefix")
    l, r = prefix.alias("l"), prefix.alias("r")
    room = F.least(F.col("l.n") - F.col("l.p"), F.col("r.n") - F.col("r.p"))
    return (l.join(r, (F.col("l.g") == F.col("r.g")) & (F.col("l.c") < F.col("r.c"))
                   & (room * (num + den) >= (F.col("l.n") + F.col("r.n")) * num) & _can_reach(num, den))
            .select(*_ordered_pair()))
