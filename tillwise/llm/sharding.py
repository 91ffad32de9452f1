"""Sharding: fixed virtual slots, bytes per slot, and a versioned slot-to-shard map.

Records hash into thousands of slots once and for all. Only the map from slots to shards is
ever edited: rebalancing moves whole slots, and every edit is a new version of the map.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwise.llm.common import text_mark
from tillwise.sources.staging import new_path, stage

N_SLOTS = 8192
TOLERANCE = 0.002  # of an even shard, when a map is edited


def record_slot(n_slots: int = N_SLOTS) -> Column:
    """Virtual slot of a record, from its id and text; it never depends on the shards."""
    return F.pmod(F.xxhash64(F.lit(9), "doc_id", text_mark()), F.lit(n_slots)).cast("int")


def first_map(n_slots: int, n_shards: int) -> list[int]:
    """Version 0, before any record is known: equal runs of slots."""
    return [slot * n_shards // n_slots for slot in range(n_slots)]


def rebalanced(
    shards: Sequence[int], loads: Sequence[int], n_shards: int, tolerance: float = 0.0
) -> list[int]:
    """The map edited until no single move or swap of slots lowers the spread of loads further.

    ``tolerance`` stops earlier, once the heaviest and the lightest shard differ by no more than that
    share of an even one. Moves go from the heaviest shard to the lightest: first the largest slot that shrinks the
    gap most, then swaps of two slots. It works on the bounded map only, never on records.
    """
    out = list(shards)
    total = [0] * n_shards
    held: list[dict[int, int]] = [{} for _ in range(n_shards)]
    for slot, shard in enumerate(out):
        if loads[slot]:
            total[shard] += loads[slot]
            held[shard][slot] = loads[slot]
    enough = tolerance * sum(total) / n_shards
    for _ in range(4 * len(out)):
        high = max(range(n_shards), key=lambda s: (total[s], -s))
        low = min(range(n_shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        if gap <= enough:
            break
        best = min(
            ((abs(gap - 2 * load), slot) for slot, load in held[high].items() if load < gap),
            default=(gap, -1),
        )
        if best[0] >= gap:
            break
        slot = best[1]
        load = held[high].pop(slot)
        held[low][slot] = load
        total[high] -= load
        total[low] += load
        out[slot] = low
    for _ in range(len(out)):  # swaps close what single moves cannot
        high = max(range(n_shards), key=lambda s: (total[s], -s))
        low = min(range(n_shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        if gap <= enough:
            break
        theirs = sorted((load, slot) for slot, load in held[low].items())
        best, pick = gap, None
        for slot, load in held[high].items():
            at = _nearest(theirs, load - gap / 2)
            for other, other_slot in theirs[max(0, at - 1) : at + 1]:
                left = abs(gap - 2 * (load - other))
                if load > other and left < best:
                    best, pick = left, (slot, load, other_slot, other)
        if pick is None:
            break
        slot, load, other_slot, other = pick
        del held[high][slot], held[low][other_slot]
        held[low][slot], held[high][other_slot] = load, other
        total[high] += other - load
        total[low] += load - other
        out[slot], out[other_slot] = low, high
    return out


def _nearest(ordered: list[tuple[int, int]], target: float) -> int:
    low, high = 0, len(ordered)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if ordered[middle][0] < target else (low, middle)
    return low


def grown(shards: Sequence[int], loads: Sequence[int], n_shards: int) -> list[int]:
    """The map with one more shard, which alone receives slots, each from the then heaviest."""
    out, total = list(shards), [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(out):
        total[shard] += loads[slot]
        heapq.heappush(held[shard], (loads[slot], slot))
    goal, new = sum(loads) / (n_shards + 1), 0
    while True:
        giver = max(range(n_shards), key=lambda s: (total[s], -s))
        if not held[giver]:
            return out
        load, slot = held[giver][0]
        if not load:
            heapq.heappop(held[giver])
            continue
        if new + load > goal:
            return out
        heapq.heappop(held[giver])
        total[giver] -= load
        new += load
        out[slot] = n_shards


def shrunk(shards: Sequence[int], loads: Sequence[int], n_shards: int) -> list[int]:
    """The map without the shards from ``n_shards`` on: their slots go to the then lightest others."""
    out, total = list(shards), [0] * n_shards
    for slot, shard in enumerate(out):
        if shard < n_shards:
            total[shard] += loads[slot]
    queue = [(t, s) for s, t in enumerate(total)]
    heapq.heapify(queue)
    homeless = [slot for slot, shard in enumerate(out) if shard >= n_shards]
    for slot in sorted(homeless, key=lambda s: (-loads[s], s)):
        least, shard = queue[0]
        out[slot] = shard
        heapq.heapreplace(queue, (least + loads[slot], shard))
    return out


class SlotMap(NamedTuple):
    """One version of the map: shard and bytes per virtual slot."""

    version: int
    shards: list[int]
    loads: list[int]

    @property
    def n_shards(self) -> int:
        return max(self.shards) + 1


_MAP = "v_slot int, shard int, bytes bigint, version int"


def map_versions(spark: SparkSession, folder: str) -> DataFrame:
    """(v_slot, shard, bytes, version): every version that was ever stored in the folder."""
    try:
        return spark.read.schema(_MAP).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MAP)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap | None:
    """The latest version of the map in a folder, or the one asked for; None if there is none."""
    stored = map_versions(spark, folder)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).orderBy("v_slot").collect()  # one row per slot
    return SlotMap(version, [r.shard for r in rows], [r.bytes for r in rows]) if rows else None


def append_map(spark: SparkSession, folder: str, found: SlotMap) -> None:
    """Store a version beside the earlier ones; to store one again is an error."""
    schema = "array<struct<v_slot:int,shard:int,bytes:bigint>>"
    text = json.dumps([{"v_slot": s, "shard": x, "bytes": found.loads[s]} for s, x in enumerate(found.shards)])
    rows = spark.range(1).select(F.inline(F.from_json(F.lit(text), schema)))
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={found.version}")


def edited(last: SlotMap, loads: Sequence[int], n_shards: int, tolerance: float = TOLERANCE) -> SlotMap:
    """The next version for new loads or another number of shards, with few slots moved.

    Shards that are new receive slots from the heaviest, shards that go hand theirs on, and then
    single slots move or change places until the shards are level within the tolerance; the first
    records are levelled as far as slots allow. The same version comes back if neither the map nor
    the loads change.
    """
    if len(loads) != len(last.shards):
        raise ValueError(f"the stored map has {len(last.shards)} slots, not {len(loads)}")
    shards = last.shards
    if last.n_shards > n_shards:
        shards = shrunk(shards, loads, n_shards)
    for count in range(max(shards) + 1, n_shards):
        shards = grown(shards, loads, count)
    shards = rebalanced(shards, loads, n_shards, tolerance if any(last.loads) else 0.0)
    if shards == last.shards and list(loads) == last.loads:
        return last
    return SlotMap(last.version + 1, shards, list(loads))


def rebalance(
    spark: SparkSession, folder: str, loads: Sequence[int], n_shards: int, tolerance: float = TOLERANCE
) -> SlotMap:
    """Load the latest map of the folder, edit it for these loads, and append what changed.

    An empty folder starts with version 0, equal runs of slots before any record is known.
    """
    last = load_map(spark, folder)
    if last is None:
        last = SlotMap(0, first_map(len(loads), n_shards), [0] * len(loads))
        append_map(spark, folder, last)
    found = edited(last, loads, n_shards, tolerance)
    if found.version != last.version:
        append_map(spark, folder, found)
    return found


def assign_shards(
    docs: DataFrame,
    n_shards: int = 24,
    n_slots: int = N_SLOTS,
    folder: str | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, v_slot, map_version) per row.

    Law ``bytes``: sizes (UTF-8 bytes plus 8) of the shards are as near to equal as moving
    whole virtual slots allows. ``slot`` is the row's place in its shard, without gaps from 0.
    NULL texts have size 8 and the checksum of an empty text; NULL ids hash like any id; equal
    rows lie side by side; an empty table gives an empty result.

    ``folder`` holds the versions of the map on shared storage. A later call with the same folder
    edits the latest of them until shards differ by ``tolerance`` at most, so rows keep their shard
    unless their slot had to move; by default the call starts a folder of its own.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    records = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        record_slot(n_slots).alias("v_slot"),
    )
    records = stage(records, "records")
    spark = docs.sparkSession
    sums = records.groupBy("v_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    loads, counts = [0] * n_slots, [0] * n_slots
    for row in sums.collect():  # at most n_slots rows
        loads[row.v_slot], counts[row.v_slot] = row.bytes, row.n
    found = rebalance(spark, folder or new_path(spark, "slot-map"), loads, n_shards, tolerance)
    shards = found.shards
    # Where each slot begins inside its shard: sums over the map, not over records.
    begins, filled = [0] * n_slots, [0] * n_shards
    for slot, shard in enumerate(shards):
        begins[slot] = filled[shard]
        filled[shard] += counts[slot]
    starts = F.from_json(F.lit(json.dumps(begins)), "array<bigint>")
    homes = F.from_json(F.lit(json.dumps(shards)), "array<int>")
    order = Window.partitionBy("v_slot").orderBy("doc_id", "text_crc32", "size")
    placed = records.withColumn("at", F.row_number().over(order) - 1)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.get(homes, F.col("v_slot")).alias("shard"),
        (F.get(starts, F.col("v_slot")) + F.col("at")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "v_slot",
        F.lit(found.version).alias("map_version"),
    )
