"""Trace trees from spans: parents, roots, broken links, depth, hand-over gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logtide.session import written

#: Spans of a trace that are linked inside its row; longer traces are linked by joins.
ROW_SPANS = 64


def link_spans(spans: DataFrame) -> DataFrame:
    """Each span with its parent's service and the gap between parent end and child start.

    ``link`` is ``root`` (no parent named), ``child``, or ``broken`` (parent not recorded).
    """
    parent = spans.select(
        "trace_id", F.col("span_id").alias("parent_span_id"),
        F.col("service").alias("parent_service"), F.col("end").alias("_parent_end"))
    return spans.join(parent, ["trace_id", "parent_span_id"], "left").select(
        *spans.columns, "parent_service",
        F.when(F.col("parent_span_id").isNull(), "root").when(F.col("_parent_end").isNull(), "broken")
        .otherwise("child").alias("link"),
        ((F.unix_micros("start") - F.unix_micros("_parent_end")) / 1000.0).alias("gap_ms"))


def trace_tree(spans: DataFrame, row_spans: int = ROW_SPANS) -> DataFrame:
    """Linked spans with their depth under the topmost recorded ancestor, and its id.

    The spans of a trace are gathered into one row, which moves them once, and are linked there. Traces of more than
    ``row_spans`` spans, and those in which a span id comes twice, are linked by joins instead; both give the same rows.
    Spans on a cycle of parent links keep a null depth. A span without a trace or without an id is in no tree.
    """
    known = spans.where(F.col("trace_id").isNotNull() & F.col("span_id").isNotNull())
    long = written(known.groupBy("trace_id").agg(F.count("*").alias("_n")).where(F.col("_n") > row_spans).select("trace_id"), "trace-long")
    short, by_joins = (known, None) if long.isEmpty() else (known.join(long, "trace_id", "left_anti"), known.join(long, "trace_id", "left_semi"))
    # Dealt by trace before they are gathered: gathering reduces nothing, so a first round before the shuffle only sorts.
    fields = F.struct(*[c for c in spans.columns if c != "trace_id"])
    rows = short.repartition("trace_id").groupBy("trace_id").agg(F.collect_list(fields).alias("_s"))
    gathered = written(rows.withColumn("_once", F.size(F.array_distinct("_s.span_id")) == F.size("_s")), "traces")
    tree = _tree_in_rows(gathered.where("_once"), spans.columns)
    repeated = gathered.where("NOT _once")
    if not repeated.isEmpty():
        again = repeated.select("trace_id", F.inline("_s")).select(*spans.columns)
        by_joins = again if by_joins is None else by_joins.select(*spans.columns).unionByName(again)
    return tree if by_joins is None else tree.unionByName(_tree_by_joins(by_joins))


def _tree_in_rows(traces: DataFrame, columns: list[str]) -> DataFrame:
    """The tree of traces that lie in one row each, ``_s`` an array of spans with ids of their own.

    Ancestors are places in that array. Depth is found by pointer doubling, log2(spans) rounds over the array; a top span
    is its own ancestor, so it stays where it is.
    """
    parents = traces.select("trace_id", "_s", F.transform("_s.parent_span_id", lambda p: F.array_position(F.col("_s.span_id"), p).cast("int") - 1).alias("_parent"))
    # A parent that is not recorded is at place -1; one without an end counts as not recorded, as in ``link_spans``.
    at = lambda array, place: F.when(place >= 0, F.get(array, place))
    linked = parents.withColumn("_up", F.transform("_parent", lambda p, i: F.when(at(F.col("_s.end"), p).isNotNull(), p).otherwise(i)))
    linked = linked.withColumn("_child", F.transform("_parent", lambda p: at(F.col("_s.end"), p).isNotNull()))
    rounds = F.slice(F.array(*[F.lit(i) for i in range(32)]), F.lit(1), F.ceil(F.log2(F.size("_s"))).cast("int"))
    start = F.struct(F.col("_up").alias("top"), F.transform("_child", lambda c: c.cast("bigint")).alias("steps"))
    settled = linked.withColumn("_t", F.aggregate(rounds, start, lambda t, _: F.struct(
        F.transform(t["top"], lambda u: F.get(t["top"], u)).alias("top"),
        F.zip_with(t["top"], t["steps"], lambda u, n: n + F.get(t["steps"], u)).alias("steps"))))
    each = settled.select("trace_id", "_s", "_parent", "_child", "_t", F.posexplode("_s").alias("_i", "_x"))
    mine = lambda array: F.get(F.col(array), F.col("_i"))
    parent, top = at(F.col("_s"), mine("_parent")), mine("_t.top")
    x, reached = F.col("_x"), ~F.get(F.col("_child"), top)
    own = {c: F.col("trace_id") if c == "trace_id" else x[c] for c in ("trace_id", "span_id", *columns)}
    return each.select(
        *[v.alias(c) for c, v in own.items()], parent["service"].alias("parent_service"),
        F.when(x["parent_span_id"].isNull(), "root").when(mine("_child"), "child").otherwise("broken").alias("link"),
        ((F.unix_micros(x["start"]) - F.unix_micros(parent["end"])) / 1000.0).alias("gap_ms"),
        F.when(reached, mine("_t.steps")).alias("depth"), F.when(reached, F.get(F.col("_s.span_id"), top)).alias("root_span_id"))


def _tree_by_joins(spans: DataFrame) -> DataFrame:
    """The tree of traces of any length.

    Depth is found by pointer doubling: round k joins each span that is not there yet to the ancestor 2^k levels up, so a
    trace of depth d takes log2(d) rounds and there is no fixed depth limit. Links are written once; a round writes only
    the spans that were still on their way. Spans left over after log2(spans) rounds sit on a cycle of parent links; they
    keep a null depth.
    """
    linked = written(link_spans(spans), "trace-links")
    has_parent = F.col("link") == "child"
    start = linked.select(
        "trace_id", "span_id", F.when(has_parent, F.col("parent_span_id")).alias("up"),
        has_parent.cast("bigint").alias("steps"), F.col("span_id").alias("top"))
    done, pending = start.where("up IS NULL"), start.where("up IS NOT NULL")
    n, left = start.agg(F.count("*"), F.count("up")).first()
    for _ in range(max(int(n), 1).bit_length() + 1):
        if not left:
            break
        above = done.unionByName(pending).select(
            "trace_id", F.col("span_id").alias("up"), F.col("up").alias("_up2"), F.col("steps").alias("_steps2"), F.col("top").alias("_top2"))
        moved = written(pending.join(above, ["trace_id", "up"]).select(
            "trace_id", "span_id", F.col("_up2").alias("up"), (F.col("steps") + F.col("_steps2")).alias("steps"), F.col("_top2").alias("top")), "trace-jumps")
        done, pending = done.unionByName(moved.where("up IS NULL")), moved.where("up IS NOT NULL")
        left = pending.count()
    known = F.col("up").isNull()
    settled = done.unionByName(pending).select(
        "trace_id", "span_id", F.when(known, F.col("steps")).alias("depth"), F.when(known, F.col("top")).alias("root_span_id"))
    return linked.join(settled, ["trace_id", "span_id"])


def trace_summary(tree: DataFrame) -> DataFrame:
    """Per trace: spans, roots, broken links, deepest level."""
    return tree.groupBy("trace_id").agg(
        F.count("*").alias("spans"), F.count_if(F.col("link") == "root").alias("roots"),
        F.count_if(F.col("link") == "broken").alias("broken"), F.max("depth").alias("max_depth"))
