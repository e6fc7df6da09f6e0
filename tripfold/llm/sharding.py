"""Consistent-hash ring with virtual nodes and bounded loads.

A key belongs to the next virtual node clockwise from its hash. A shard takes keys
up to its capacity; keys that find it full continue clockwise to the next virtual
node of a shard with room. The walk needs no keys, only how many lie on each arc of
the ring, so it runs on a table bounded by the number of virtual nodes; each row then
finds its shard by its rank on its arc.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripfold.llm.ordered import kept

CELLS = 4096  # the ring in equal parts, each with its few virtual nodes, for a lookup by join
CELL_BITS = 52  # bits of a hash below its cell
PART_ROWS = 1_000_000  # rows of an arc ranked in one task, about


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes, clockwise. A further shard leaves the others' places alone."""
    nodes = []
    for shard in range(shards):
        for copy in range(virtual_nodes):
            digest = hashlib.blake2b(f"{shard}/{copy}".encode(), digest_size=8).digest()
            nodes.append((int.from_bytes(digest, "little", signed=True), shard))
    return sorted(nodes)


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows a shard may hold: (1 + slack) of the mean; without slack they add up to the rows exactly."""
    if slack > 0:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


@dataclass
class Run:
    """Rows `begin` to `end` - 1 of an arc, and where they go."""

    arc: int
    begin: int
    end: int
    shard: int
    slot: int


def walk(counts: dict[int, int], owners: list[int], room: list[int]) -> list[Run]:
    """Places the arcs' rows: each arc at its own shard first, arc by arc clockwise, then the overflow onwards."""
    if sum(room) < sum(counts.values()):
        raise ValueError("the shards hold fewer rows than there are")
    room, taken, runs = list(room), [0] * len(room), []
    waiting: dict[int, list[tuple[int, int, int]]] = {arc: [(arc, 0, n)] for arc, n in counts.items() if n}
    while waiting:
        left: list[tuple[int, tuple[int, int, int]]] = []
        for arc in sorted(waiting):
            shard = owners[arc]
            for home, begin, end in waiting[arc]:
                n = min(room[shard], end - begin)
                if n:
                    runs.append(Run(home, begin, begin + n, shard, taken[shard]))
                    room[shard] -= n
                    taken[shard] += n
                if begin + n < end:
                    left.append((arc, (home, begin + n, end)))
        waiting = {}
        for arc, rows in left:
            arc = (arc + 1) % len(owners)
            while not room[owners[arc]]:  # some shard has room, as rows are left
                arc = (arc + 1) % len(owners)
            waiting.setdefault(arc, []).append(rows)
    return runs


def _cell(place: Column | int):
    return F.shiftright(place, CELL_BITS) if isinstance(place, Column) else place >> CELL_BITS


def _cells(spark: SparkSession, places: list[int]) -> DataFrame:
    """For each cell of the ring: the virtual nodes before it, and those in it."""
    rows = []
    for cell in range(-CELLS // 2, CELLS // 2):
        low, high = bisect_left(places, cell << CELL_BITS), bisect_left(places, (cell + 1) << CELL_BITS)
        rows.append((cell, low, places[low:high]))
    return spark.createDataFrame(rows, "cell long, before int, nodes array<long>")


def assign_shards(docs: DataFrame, shards: int, virtual_nodes: int = 128, slack: float = 0.0) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot, grown_shard, home_shard.

    Law `rows` (slack 0): row counts of any two shards differ by at most one. With
    slack, no shard holds more than (1 + slack) of the mean, and fewer rows leave
    their home shard (the one that the ring alone gives). Slots are gapless in a
    shard. Null text counts as empty; a null doc_id hashes like any other key. Rows that
    share a doc_id share an arc, however many: what does not fit overflows. An
    empty table gives no rows.

    Texts are read once and not moved, however long. An arc's rows are ranked in parts of about PART_ROWS,
    so that a hot arc is not one task; the table of the parts is joined, never broadcast. The driver
    gets one count per arc, and the broadcast tables have a row per arc, run or cell.
    """
    spark = docs.sparkSession
    nodes = ring(shards, virtual_nodes)
    places, owners = [p for p, _ in nodes], [s for _, s in nodes]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    ).withColumn("place", F.xxhash64("doc_id"))
    cells = F.broadcast(_cells(spark, places))
    inside = F.size(F.filter("nodes", lambda n: n < F.col("place")))
    arc = ((F.col("before") + inside) % len(nodes)).alias("arc")
    rows = kept(rows.withColumn("cell", _cell(F.col("place"))).join(cells, "cell").select("doc_id", "size", "text_crc32", "salt", "place", arc))

    totals = {r.arc: r.n for r in rows.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    runs = walk(totals, owners, capacities(sum(totals.values()), shards, slack))
    table = spark.createDataFrame([(r.arc, r.begin, r.end, r.shard, r.slot, owners[r.arc]) for r in runs], "arc int, begin long, end long, shard int, first long, home_shard int")

    parts = F.get(F.lit([-(-totals.get(a, 1) // PART_ROWS) for a in range(len(nodes))]), F.col("arc"))
    rows = rows.withColumn("part", F.pmod("salt", parts.cast("long")))
    counts = rows.groupBy("arc", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("arc", "part").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1).join(firsts.hint("shuffle_merge"), ["arc", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("skip"))
    found = ranked.join(F.broadcast(table), "arc").where("rank >= begin and rank < end")
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("first") + F.col("rank") - F.col("begin")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "home_shard",
    )
