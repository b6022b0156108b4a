"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

1. Every record is hashed by its text into one of ``slots`` virtual slots, so
   equal texts share a slot. A slot that holds more than a quarter of a shard's
   fair share is cut into pieces by the record's place in the staged input, so
   a group of copies that fills a third of the table spreads like any other.
2. Bytes and rows per (slot, piece) are aggregated map-side. These loads are a
   bounded table: ``slots`` plus at most ``PIECES`` pieces per shard, whatever
   the input size. The first map deals them to the shards, heaviest first, each
   to the lightest shard.
3. The map is a stored table with a version. Rebalancing (more shards, or other
   loads) does not deal anew: it writes the next version, in which slots leave
   shards above the mean for shards below it, heaviest fitting slot first.
   Adding shards moves slots only into the new ones.
4. Places inside a shard are gapless: rows are numbered within chunks of a slot
   (``CHUNK_ROWS`` on average), and chunk counts, not rows, are summed over the
   shard to give the chunk's first place.

The law is ``bytes``: shards are of nearly equal size, as far as single records
allow (a record is never cut).

Defined cases: a null text has no bytes (size ``OVERHEAD``, CRC 0); null and
repeated doc_ids are ordinary records; rows that repeat everything are told
apart by their place in the staged input; an empty table gives an empty result
and an empty map. Very long texts are hashed whole and weigh what they are.
Further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from turnstone.llm.shared import stage

SLOTS = 4096
SHARDS = 24
OVERHEAD = 8
PIECES = 16
CHUNK_ROWS = 50_000
MAP = "version int, vslot int, piece int, shard int"


def place_records(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, piece, place) per record, staged."""
    text = docs["text"]
    rows = stage(docs.select(
        docs["doc_id"], (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(slots)).cast("int").alias("vslot"),
        F.monotonically_increasing_id().alias("place")), "records")
    loads = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    fair = sum(r["bytes"] for r in loads) / shards
    hot = [(r["vslot"], min(r["n"], math.ceil(PIECES * r["bytes"] / fair))) for r in loads
           if r["bytes"] > fair / 4 and r["n"] > 1]  # at most four slots per shard
    if not hot:
        return rows.withColumn("piece", F.lit(0))
    cut = F.broadcast(rows.sparkSession.createDataFrame(hot, "vslot int, pieces int"))
    piece = F.coalesce(F.pmod(F.xxhash64("place"), F.col("pieces")), F.lit(0)).cast("int")
    return rows.join(cut, "vslot", "left").withColumn("piece", piece).drop("pieces")


def slot_loads(records: DataFrame) -> DataFrame:
    """(vslot, piece, bytes, n): what each virtual slot holds."""
    return records.groupBy("vslot", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def first_map(loads: list, shards: int = SHARDS) -> list[tuple]:
    """Version 1 of the map: slots from heavy to light, each to the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for r in sorted(loads, key=lambda r: (-r["bytes"], r["vslot"], r["piece"])):
        held, s = heapq.heappop(heap)
        out.append((1, r["vslot"], r["piece"], s))
        heapq.heappush(heap, (held + r["bytes"], s))
    return out


def rebalance(current: list, loads: list, shards: int) -> list[tuple]:
    """The next version of ``current`` for new loads or another number of shards, with few moves.

    Slots without a load keep their shard, slots that are new or whose shard is
    gone go to the lightest one. A slot moves if that narrows the gap
    between the two shards; with added shards only those receive slots.
    """
    version = max((r[0] for r in current), default=0)
    old = {(v, p): s for n, v, p, s in current if n == version}
    bytes_of = {(r["vslot"], r["piece"]): r["bytes"] for r in loads}
    held = [0] * shards
    mine: list[list] = [[] for _ in range(shards)]
    shard_of = {k: s for k, s in old.items() if s < shards}
    for k, s in shard_of.items():
        held[s] += bytes_of.get(k, 0)
    for k in sorted((k for k in {*old, *bytes_of} if k not in shard_of), key=lambda k: (-bytes_of.get(k, 0), k)):
        shard_of[k] = held.index(min(held))
        held[shard_of[k]] += bytes_of.get(k, 0)
    before = max(old.values(), default=-1) + 1
    takers = range(before, shards) if 0 < before < shards else range(shards)
    for k, s in shard_of.items():
        mine[s].append((bytes_of.get(k, 0), k))
    for x in mine:
        x.sort(reverse=True)
    mean = sum(held) / shards if shards else 0
    givers = [(-h, s) for s, h in enumerate(held)]
    heapq.heapify(givers)
    while givers:
        _, s = heapq.heappop(givers)
        if held[s] <= mean:
            break
        t = min(takers, key=lambda x: (held[x], x))
        room = mean - held[t]
        # the heaviest slot that neither overfills the taker nor empties the giver below the mean by more than it gains
        move = next((m for m in mine[s] if m[0] and m[0] <= min(room, held[s] - mean)), None)
        if move is None:
            continue
        mine[s].remove(move)
        mine[t].append(move)
        shard_of[move[1]] = t
        held[s] -= move[0]
        held[t] += move[0]
        heapq.heappush(givers, (-held[s], s))
    return [(version + 1, v, p, s) for (v, p), s in sorted(shard_of.items())]


def write_map(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Add one version to the stored map; earlier versions stay readable."""
    for version in sorted({r[0] for r in rows}):
        spark.createDataFrame([r for r in rows if r[0] == version], MAP).coalesce(1).drop("version").write.mode(
            "overwrite").parquet(os.path.join(path, f"version={version}"))


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the newest by default."""
    stored = spark.read.parquet(path).select("version", "vslot", "piece", "shard")
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def assign(records: DataFrame, slot_map: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``records`` with shard, place in the shard (slot) and map version."""
    loads = stage(slot_loads(records).join(F.broadcast(slot_map), ["vslot", "piece"]), "loads")  # bounded by the slots
    most = loads.agg(F.max("n")).first()[0] or 0
    chunks = max(1, math.ceil(most / chunk_rows))
    rows = records.join(F.broadcast(loads.select("vslot", "piece", "shard", "version")), ["vslot", "piece"]).withColumn(
        "chunk", F.pmod(F.xxhash64("place", F.lit(7)), F.lit(chunks)).cast("int"))
    counts = rows.groupBy("shard", "version", "vslot", "piece", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("vslot", "piece", "chunk").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select("vslot", "piece", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    mine = W.partitionBy("vslot", "piece", "chunk").orderBy("doc_id", "place")
    return (rows.withColumn("r", F.row_number().over(mine)).join(first, ["vslot", "piece", "chunk"])
            .withColumn("slot", (F.col("first") + F.col("r") - 1).cast("bigint")).drop("r", "first", "chunk"))


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, current: DataFrame | None = None,
          path: str | None = None) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version.

    ``current``: the map in force, which is edited for these loads; without it
    the slots are dealt anew. The version used is stored under ``path``, or
    else as a staged table.
    """
    spark = docs.sparkSession
    records = place_records(docs, slots, shards)
    loads = slot_loads(records).collect()  # slots and pieces, not records
    rows = first_map(loads, shards) if current is None else rebalance([tuple(r) for r in current.collect()], loads, shards)
    if path is None:
        slot_map = stage(spark.createDataFrame(rows, MAP), "slot-map")
    else:
        write_map(spark, rows, path)
        slot_map = read_map(spark, path)
    return assign(records, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version"))
