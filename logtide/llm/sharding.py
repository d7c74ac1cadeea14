"""Sharding on a consistent-hash ring with virtual nodes and bounded loads. DataFrame functions only."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window, functions as F

from logtide.session import written

CELL_BITS = 13
SALTS = 8


def _position(shard: int, replica: int, cells: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{shard}:{replica}".encode()).digest()[:8], "big") % cells


def ring(shards: int, replicas: int = 64, cells: int = 1 << CELL_BITS) -> list[list[int]]:
    """For each cell of the ring the shards in clockwise order from it, each once."""
    nodes = sorted((_position(s, r, cells), s) for s in range(shards) for r in range(replicas))
    out, at = [], 0
    for cell in range(cells):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        order: dict[int, None] = {}
        for k in range(len(nodes)):
            order.setdefault(nodes[(at + k) % len(nodes)][1])
            if len(order) == shards:
                break
        out.append(list(order))
    return out


def plan_segments(counts: list[tuple[int, int, int]], shards: int, replicas: int = 64) -> list[tuple]:
    """Which ranks of each (cell, salt) go to which shard: ``(cell, salt, start, end, shard, slot)``.

    Every cell first fills the shard that owns it, up to a capacity of one N-th of the rows; what overflows continues
    clockwise to the next shard with room. Capacities add up to the rows, so every shard is filled to its capacity.
    Input and output have at most cells x salts (plus splits) entries, whatever the number of rows.
    """
    total = sum(n for *_, n in counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    order = ring(shards, replicas)
    out, waiting = [], []

    def place(cell: int, salt: int, start: int, n: int, shard: int) -> int:
        took = min(n, room[shard] - used[shard])
        if took:
            out.append((cell, salt, start, start + took, shard, used[shard]))
            used[shard] += took
        return took

    for cell, salt, n in sorted(counts):
        took = place(cell, salt, 0, n, order[cell][0])
        if took < n:
            waiting.append((cell, salt, took, n))
    for cell, salt, start, n in waiting:
        for shard in order[cell][1:]:
            start += place(cell, salt, start, n - start, shard)
            if start == n:
                break
    return out


def shard_rows(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", replicas: int = 64) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; row counts of shards differ by one at most.

    A row's place on the ring comes from its id, so copies of a text, and a source that holds a third of the rows, spread
    over all shards; rows that repeat an id meet in one cell and are split by a salt there. Only counts of cells reach the
    driver (at most 2^16 of them); rows are numbered within (cell, salt) and joined to the segments of the plan.

    Null text: size 8, crc of no bytes. A null id hashes like any value. Empty tables give no rows. Other columns are not
    read.
    """
    cell = F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 64 - CELL_BITS).cast("int")
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))).alias("text_crc32"),
        cell.alias("_cell"), (F.monotonically_increasing_id() % SALTS).cast("int").alias("_salt")), "ringed")
    counts = [tuple(r) for r in rows.groupBy("_cell", "_salt").count().collect()]
    segments = rows.sparkSession.createDataFrame(
        plan_segments(counts, shards, replicas), "_cell int, _salt int, _start long, _end long, shard int, _slot long")
    inside = Window.partitionBy("_cell", "_salt").orderBy("doc_id", "size", "text_crc32")
    ranked = rows.withColumn("_rank", F.row_number().over(inside).cast("long") - 1)
    return (ranked.join(segments, ["_cell", "_salt"]).where("_rank >= _start AND _rank < _end")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_slot") + F.col("_rank") - F.col("_start")).alias("slot")))
