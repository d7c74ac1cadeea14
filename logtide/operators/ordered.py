"""Order-dependent operators that split long groups instead of sorting each in one task.

A log has few partitions and a metric few label sets, so ``over (partition by topic,
partition order by ...)`` would hand a third of all rows to one task. Two devices avoid
that here:

* ``dense_positions`` sorts by range over the whole cluster, numbers rows inside each
  range and adds the row count of the ranges before it.
* The ``chunked_*`` functions cut a group into chunks along its order, run the window
  inside chunks, and carry one summary row per chunk across chunk borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtide.session import written

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def dense_positions(df: DataFrame, groups: list[str], order: list[str], name: str = "position") -> DataFrame:
    """0-based position of each row in its group, in ``order``.

    ``groups`` + ``order`` has to be unique for the numbering to be reproducible. The
    ranged rows are written once: the numbering must not be computed from a second,
    differently sampled range split. The per-range counts have at most (ranges + groups)
    rows; they are written too, so that Spark knows their real size when it decides
    whether to broadcast them.
    """
    ranged = df.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    rid = F.monotonically_increasing_id()
    tagged = written(ranged.withColumn("_rid", rid), "ranged").select(
        "*",
        F.shiftright("_rid", _ROW_BITS).alias("_range"),
        F.col("_rid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    counts = tagged.groupBy(*groups, "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.select(
        *groups, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "ranges")
    return (
        tagged.join(starts, [*groups, "_range"])
        .withColumn(name, F.col("_row") + F.col("_shift"))
        .drop("_rid", "_range", "_row", "_shift")
        .select(*df.columns, name)
    )


SAMPLE_ROWS = 20_000


def order_bounds(df: DataFrame, order: list[str], chunks: int, sample_rows: int = SAMPLE_ROWS) -> list[tuple]:
    """Up to ``chunks - 1`` values of ``order`` that cut the rows into chunks of similar size.

    Taken from about ``sample_rows`` rows, chosen by a hash of their order: the driver never holds more, and cuts only
    decide where rows are numbered, not which number they get.
    """
    rows = df.select(*order)
    step = max(1, rows.count() // sample_rows)
    sample = rows.where(F.pmod(F.xxhash64(*order), F.lit(step)) == 0).limit(4 * sample_rows).collect()
    ranked = sorted((tuple(r) for r in sample), key=lambda r: [(x is not None, x) for x in r])
    return sorted({ranked[len(ranked) * i // chunks] for i in range(1, chunks)} if ranked else [], key=lambda r: [(x is not None, x) for x in r])


def chunk_of(place: Column, cuts: Column, n: int) -> Column:
    """How many of the ``n`` ascending ``cuts`` are at or before ``place``, found by halving: log2(n) comparisons a row, not n."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    # The place is bound to a name, so a row computes it once and not at every step. A step past the last cut compares with
    # null, so it is not taken.
    return F.get(F.transform(F.array(place), lambda at: F.aggregate(
        steps, F.lit(0), lambda upto, step: F.when(F.get(cuts, upto + step - 1) <= at, upto + step).otherwise(upto))), F.lit(0))


def chunked_positions(df: DataFrame, groups: list[str], order: list[str], name: str = "position", chunks: int | None = None) -> DataFrame:
    """0-based position of each row in its group, in ``order``; for few groups of any size.

    ``groups`` + ``order`` has to be unique. Rows are counted per group and chunk of the order on these columns alone, and
    the counts (at most groups x chunks rows) give every chunk its first number. The rows themselves move once, to be
    numbered inside their chunk; nothing is written in between, and the same rows get the same numbers every time.
    """
    spark = df.sparkSession
    chunks = chunks or min(128, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bounds = order_bounds(df, order, chunks)
    types = [df.schema[c].dataType for c in order]
    place = F.struct(*order)
    cuts = F.array(*[F.struct(*[F.lit(x).cast(t).alias(c) for x, t, c in zip(b, types, order, strict=True)]) for b in bounds])
    chunk = (chunk_of(place, cuts, len(bounds)) if bounds else F.lit(0)).alias("_chunk")
    counts = df.select(*groups, chunk).groupBy(*groups, "_chunk").agg(F.count("*").alias("n")).collect()
    starts, upto = [], {}
    for r in sorted(counts, key=lambda r: r["_chunk"]):
        group = tuple(r[g] for g in groups)
        starts.append((*group, r["_chunk"], len(starts), upto.get(group, 0)))
        upto[group] = upto.get(group, 0) + r["n"]
    fields = ", ".join(f"`_g{i}` {df.schema[g].dataType.simpleString()}" for i, g in enumerate(groups))
    known = F.broadcast(spark.createDataFrame(starts, f"{fields}{', ' if fields else ''}_c int, _cell int, _start long"))
    cut = df.select("*", chunk)
    # Null-safe, though no chunk is null: from a plain equality Spark infers a filter "chunk is known", pushes it down to the
    # scan and computes every chunk once more there.
    same = F.col("_chunk").eqNullSafe(F.col("_c"))
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    # A chunk of a group has a number of its own, so rows are sorted by it and not by the names of their group.
    inside = Window.partitionBy("_cell").orderBy(*order)
    numbered = cut.join(known, same).withColumn("_no", F.row_number().over(inside))
    return numbered.select(*df.columns, (F.col("_start") + F.col("_no") - 1).alias(name))


def offset_chunk(col: str = "offset", rows: int = 1_000_000) -> Column:
    """Chunk of a log position; holds at most ``rows`` rows because offsets are unique."""
    return F.floor(F.col(col) / F.lit(rows))


def time_chunk(col: str = "ts", seconds: int = 86_400) -> Column:
    """Chunk of an event time; for series whose sampling interval bounds the rows per chunk."""
    return F.floor(F.unix_seconds(F.col(col)) / F.lit(seconds))


def _neighbour(df: DataFrame, keys: list[str], order: list[str], values: list[str], chunk: Column,
               prefix: str, forward: bool) -> DataFrame:
    cut = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    shift = F.lead if forward else F.lag
    marked = cut.select(
        "*",
        *[shift(v).over(inside).alias(f"_in_{v}") for v in values],
        shift(F.lit(True)).over(inside).alias("_has_near"),
    )
    edge_pick = F.min_by if forward else F.max_by
    edges = cut.groupBy(*keys, "_chunk").agg(
        edge_pick(F.struct(*[F.col(v).alias(f"_out_{v}") for v in values]), F.struct(*order)).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    carried = edges.select(*keys, "_chunk", shift("_edge").over(across).alias("_carried"))
    joined = marked.join(carried, [*keys, "_chunk"], "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_has_near"), F.col(f"_in_{v}")).otherwise(F.col(f"_carried._out_{v}")).alias(prefix + v)
          for v in values],
    )


def chunked_lag(df: DataFrame, keys: list[str], order: list[str], values: list[str], chunk: Column,
                prefix: str = "prev_") -> DataFrame:
    """``lag(value) over (partition by keys order by order)`` for each of ``values``."""
    return _neighbour(df, keys, order, values, chunk, prefix, forward=False)


def chunked_lead(df: DataFrame, keys: list[str], order: list[str], values: list[str], chunk: Column,
                 prefix: str = "next_") -> DataFrame:
    """``lead(value) over (partition by keys order by order)`` for each of ``values``."""
    return _neighbour(df, keys, order, values, chunk, prefix, forward=True)


def chunked_running_max(df: DataFrame, keys: list[str], order: list[str], value: str, chunk: Column,
                        name: str) -> DataFrame:
    """Running maximum of ``value`` along the order; nulls do not count."""
    cut = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, "_chunk").agg(F.max(value).alias("_m"))
        .select(*keys, "_chunk", F.max("_m").over(before).alias("_carried"))
    )
    return (
        cut.withColumn("_inside", F.max(value).over(inside))
        .join(carried, [*keys, "_chunk"], "left")
        .select(*df.columns, F.greatest("_inside", "_carried").alias(name))
    )


def chunked_next_known(df: DataFrame, keys: list[str], order: list[str], value: str, chunk: Column,
                       name: str) -> DataFrame:
    """The first non-null ``value`` at or after each row in its group.

    The windows run backwards with a growing frame, which Spark extends row by row; a
    frame up to the end of the group would be evaluated anew for every row.
    """
    cut = df.withColumn("_chunk", chunk)
    backwards = [F.col(c).desc() for c in order]
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*backwards).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*keys).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    known_at = F.when(F.col(value).isNotNull(), F.struct(*order))
    carried = (
        cut.groupBy(*keys, "_chunk").agg(F.min_by(value, known_at).alias("_v"))
        .select(*keys, "_chunk", F.last("_v", ignorenulls=True).over(after).alias("_carried"))
    )
    inner = cut.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
    same = [inner[k].eqNullSafe(carried[k]) for k in [*keys, "_chunk"]]
    return inner.join(carried, same, "left").select(
        *[inner[c] for c in df.columns], F.coalesce("_inside", "_carried").alias(name))


def trailing_sum(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, name: str,
                 block_seconds: int = 86_400) -> DataFrame:
    """Sum of ``value`` over the trailing window ``(ts - seconds, ts]`` of each row.

    Rows are grouped by (keys, time block). A row that the next block still looks back
    on is copied there as context, so no block has to see the whole series.
    """
    if seconds > block_seconds:
        raise ValueError("the window must fit in one block")
    second = F.unix_micros(ts)
    span, block = seconds * 1_000_000, block_seconds * 1_000_000
    own = F.floor(second / F.lit(block))
    # A row at time t is seen from [t, t + span), which touches this block and maybe the next.
    reach = F.floor((second + F.lit(span - 1)) / F.lit(block))
    placed = df.withColumn("_block", F.explode(F.sequence(own, reach))).withColumn("_context", F.col("_block") != own)
    look_back = Window.partitionBy(*keys, "_block").orderBy(F.unix_micros(ts)).rangeBetween(-(span - 1), 0)
    return (
        placed.withColumn(name, F.sum(value).over(look_back))
        .filter(~F.col("_context"))
        .select(*df.columns, name)
    )
