"""Operator 3: consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` points of a 2^32 ring and every row a position
(hash of doc_id and text digest). A row belongs to the first point clockwise
of its position. Each shard has a capacity (law ``rows``: n/shards rounded so
that the capacities add up to n); rows that find their shard full continue
clockwise to the next point of a shard with room, so counts differ by at most
one, and only overflowing rows leave their home shard.

How it runs: rows are counted per ring *cell* (an arc cut in equal pieces; the
number of cells follows the row count). Only the per-arc totals reach the
driver: ``shards * VNODES`` numbers whatever the input. There the arcs are
walked clockwise once and each arc's rows, in ring order, are dealt to shards as
``[from, to)`` rank ranges. Rows get their rank inside an arc from a running
sum over cells plus a row number inside the cell, and take the shard of the
range that holds the rank. All of it is DataFrame code.

Nulls: a null text has size 1 and the digest of the empty text; a null doc_id
hashes like any value. Equal rows are counted once with their multiplicity and
fanned out at the end, so copies of one row never meet in one task. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .native import crc32_text
from .store import table, written

RING = 1 << 32
PIECES = 4096
VNODES = 128
ROWS_PER_CELL = 20_000


def ring_points(spark, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise."""
    at = (spark.range(shards * vnodes)
          .select(F.floor(F.col("id") / vnodes).cast("int").alias("shard"), (F.col("id") % vnodes).alias("copy"))
          # a point depends on its shard and number alone: other shards come and go without moving it
          .select("shard", F.pmod(F.xxhash64(F.lit("vnode"), "shard", "copy"), F.lit(RING)).alias("at")))
    return sorted((r["at"], r["shard"]) for r in at.collect())


def deal(points: list[tuple[int, int]], arc_rows: dict[int, int], shards: int) -> list[tuple]:
    """Walk the arcs clockwise and give each arc's ranks to shards with room.

    Arc ``i`` holds the rows between point i-1 and point i; its rows go to the
    owner of point i while that shard has room, the rest clockwise onwards.
    All arcs first fill their own shards, then the overflow moves on, so no
    row is pushed out by a row from further away. Returns
    (arc, first rank, end rank, shard, first slot).
    """
    total = sum(arc_rows.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    left: list[tuple[int, int, int]] = []  # arc, first rank not placed, end
    out = []

    def place(arc: int, lo: int, hi: int, shard: int) -> int:
        take = min(hi - lo, room[shard] - used[shard])
        if take > 0:
            out.append((arc, lo, lo + take, shard, used[shard]))
            used[shard] += take
        return lo + max(take, 0)

    for arc, (_, shard) in enumerate(points):
        n = arc_rows.get(arc, 0)
        lo = place(arc, 0, n, shard)
        if lo < n:
            left.append((arc, lo, n))
    for arc, lo, n in left:
        step = 1
        while lo < n:
            lo = place(arc, lo, n, points[(arc + step) % len(points)][1])
            step += 1
    return out


def assign(docs: DataFrame, shards: int = 8, vnodes: int = VNODES) -> DataFrame:
    """Shard, slot and digests of every row: doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    points = ring_points(spark, shards, vnodes)
    ends = [p for p, _ in points]
    keyed = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        crc32_text(F.col("text")).alias("text_crc32"))
    rows = (keyed.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
            .withColumn("pos", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(RING))))
    rows = written(rows, "shard_rows")
    total = rows.agg(F.sum("copies")).first()[0] or 0
    # cells follow the row count; (arc, lap, cell) orders rows like their position
    cells = max(1, -(-total // ROWS_PER_CELL))
    width = -(-RING // cells)
    rows = rows.withColumn("cell", F.floor(F.col("pos") / F.lit(width)).cast("long"))
    near = (spark.createDataFrame(_piece_arcs(ends), "piece long, arc_end long, arc int")
            .groupBy("piece").agg(F.sort_array(F.collect_list(F.struct("arc_end", "arc"))).alias("ends")))
    rows = (rows.withColumn("piece", F.floor(F.col("pos") / F.lit(RING // PIECES)).cast("long"))
            .join(F.broadcast(near), "piece")
            .withColumn("arc", F.filter("ends", lambda e: e["arc_end"] >= F.col("pos"))[0]["arc"])
            .drop("ends", "piece"))
    # the wrap-around rows (beyond the last point) come first in arc 0
    lap = F.when((F.col("arc") == 0) & (F.col("pos") > F.lit(ends[0])), 0).otherwise(1)
    rows = rows.withColumn("lap", lap)
    per_cell = written(rows.groupBy("arc", "lap", "cell").agg(F.sum("copies").alias("n")), "shard_cells")
    arcs = {r["arc"]: r["n"] for r in per_cell.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    ranges = spark.createDataFrame(
        deal(points, arcs, shards), "arc int, lo long, hi long, shard int, first_slot long")
    before = per_cell.withColumn(
        "before", F.sum("n").over(W.partitionBy("arc").orderBy("lap", "cell")) - F.col("n")).drop("n")
    order = W.partitionBy("arc", "lap", "cell").orderBy("pos", "doc_id", "size", "text_crc32")
    ranked = (rows.withColumn("upto", F.sum("copies").over(order))
              .join(before, ["arc", "lap", "cell"])
              .withColumn("rank0", F.col("before") + F.col("upto") - F.col("copies"))
              .withColumn("rank", F.explode(F.sequence(F.col("rank0"), F.col("rank0") + F.col("copies") - 1))))
    r = ranges.withColumnRenamed("arc", "range_arc")
    return (ranked.join(F.broadcast(r), (F.col("arc") == F.col("range_arc"))
                        & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first_slot") + F.col("rank") - F.col("lo")).alias("slot")))


def _piece_arcs(ends: list[int]) -> list[tuple[int, int, int]]:
    """For every one of PIECES equal pieces of the ring the arcs that meet it:
    (piece, last position, arc). A fixed lookup table, whatever the input."""
    out, width = [], RING // PIECES
    for piece in range(PIECES):
        lo, hi = piece * width, (piece + 1) * width - 1
        i = bisect.bisect_left(ends, lo)
        while True:
            end = ends[i] if i < len(ends) else RING - 1
            out.append((piece, min(end, hi), i % len(ends)))
            if end >= hi:
                break
            i += 1
    return out


def op3(spark, sf_dir: str) -> DataFrame:
    """Law ``rows``: every document in one of 8 shards, counts at most one apart."""
    placed = assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
