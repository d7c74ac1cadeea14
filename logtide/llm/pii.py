"""Personal data: exact base patterns, and contexts learned from them that find further identifiers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtide.llm.common import give_back
from logtide.session import written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),  # a match always begins a run of digits: linear time
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").finditer
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_digits = re.compile(r"[0-9]+").findall
_token = re.compile(r"[A-Za-z0-9][A-Za-z0-9._@+-]*[A-Za-z0-9]")
_before = re.compile(r"(\S+)\s+(\S+)[\s:=#(<\"']*$")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    digits = "".join(_digits(found))
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the e-mail pattern in linear time: from every domain to the left, down to the match before."""
    done = 0
    for m in _domain(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches by kind as listed, then start; code points, end exclusive. A match that fails its check is dropped."""
    out = []
    for kind, pattern in PATTERNS.items():
        if kind == "email":
            out += [(kind, *span) for span in _emails(text)] if "@" in text else []
            continue
        if kind == "phone" and "+" not in text:
            continue
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _holds(kind, m[0])]
    return out


def _context(text: str, start: int) -> str | None:
    """The lexical pattern before a position: the two words before it, digits masked; None without two words."""
    m = _before.search(text[max(0, start - 80):start])
    return re.sub(r"[0-9]+", "0", f"{m[1]} {m[2]}".lower()) if m else None


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, str, str | None, int, int]]:
    """``(pattern, instance, kind, start, end)``: identifiers with a context; kind only for base matches, the seeds.

    Other identifiers are tokens outside base matches with four digits or more, or an at sign.
    """
    out = []
    for kind, start, end in base:
        if pattern := _context(text, start):
            out.append((pattern, text[start:end].lower(), kind, start, end))
    taken, done = [(s, e) for _, s, e in base], 0
    for run in re.finditer(r"[0-9]{2,}|@", text):
        if run.start() < done:
            continue
        left = run.start()
        while left > done and (text[left - 1] in _LOCAL or text[left - 1] == "@"):
            left -= 1
        m = _token.search(text, left)
        done = m.end() if m else run.end()
        if not m or sum(c.isdigit() for c in m[0]) < 4 and "@" not in m[0] or m.end() - m.start() > 64:  # longer strings are no identifiers
            continue
        if any(s < m.end() and m.start() < e for s, e in taken):
            continue
        if pattern := _context(text, m.start()):
            out.append((pattern, m[0].lower(), None, m.start(), m.end()))
    return out


SCANNED = ("base array<struct<kind:string,start:int,end:int>>, "
           "found array<struct<pattern:string,instance:string,kind:string,start:int,end:int>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    item = pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        base, found = [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            spans = base_spans(text)
            base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
            found.append([dict(zip(("pattern", "instance", "kind", "start", "end"), c, strict=True)) for c in candidates(text, spans)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(base, pa.list_(span)), pa.array(found, pa.list_(item))],
                                         names=["doc_id", "digest", "base", "found"])
        batch = base = found = None
        give_back()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, digest`` of the text, base spans, and identifiers with their contexts."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("digest"))
    return picked.mapInArrow(_scan, "doc_id long, digest string, " + SCANNED)


def score_patterns(scanned: DataFrame, rounds: int = 3, seeds: int = 3, sure: float = 0.8) -> DataFrame:
    """``pattern, kind, score`` of the patterns that are sure enough to find identifiers.

    The graph links a pattern to the distinct identifiers that follow it. Seeds have belief 1 in their kind, others begin
    at 0. In each round a pattern's score in a kind is the mean belief of its instances (one more instance without belief
    is added, so that rare patterns score low), and an identifier that is no seed believes what its sure patterns say,
    combined as independent evidence. Only patterns with ``seeds`` distinct seeds of a kind, or more, can be sure.
    """
    links = written(scanned.select(F.explode("found").alias("f")).groupBy("f.pattern", "f.instance").agg(F.max("f.kind").alias("seed")), "graph")
    kinds = links.where("seed IS NOT NULL").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count("*").alias("n_seeds")).where(F.col("n_seeds") >= seeds)
    graph = written(links.join(kinds, "pattern"), "graph")
    beliefs = graph.select("pattern", "instance", "kind", F.when(F.col("seed") == F.col("kind"), 1.0).otherwise(0.0).alias("belief"))
    scores = None
    for _ in range(rounds):
        scores = beliefs.groupBy("pattern", "kind").agg((F.sum("belief") / (F.count("*") + 1)).alias("score"))
        said = graph.join(scores, ["pattern", "kind"])
        doubt = said.groupBy("instance", "kind").agg(F.exp(F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.999))))).alias("doubt"))
        beliefs = written(graph.join(doubt, ["instance", "kind"]).select(
            "pattern", "instance", "kind",
            F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed").isNotNull(), 0.0).otherwise(1 - F.col("doubt")).alias("belief")), "beliefs")
    return beliefs.groupBy("pattern", "kind").agg((F.sum("belief") / (F.count("*") + 1)).alias("score")).where(F.col("score") >= sure)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, seeds: int = 3, sure: float = 0.8) -> DataFrame:
    """``doc_id, digest, base, extra`` for every row: exact base spans, and the spans that sure patterns add.

    One pass over the texts keeps base spans and identifiers with contexts; patterns are scored on the graph of these, and
    identifiers behind a sure pattern are reported with its kind unless they touch a base span.

    Null text counts as empty and has no spans. Rows with the same id and text get the same spans. Null ids stay null.
    Empty tables give no rows; other columns are not read.
    """
    scanned = written(scan(docs, id_col, text_col), "scanned")
    sure_patterns = score_patterns(scanned, rounds, seeds, sure)
    hits = scanned.select("doc_id", "digest", F.explode("found").alias("f")).where("f.kind IS NULL").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "f.pattern", "f.start", "f.end")
    best = hits.join(sure_patterns, "pattern").groupBy("_id", "_digest", "start", "end").agg(F.max(F.struct("score", "kind")).alias("b"))
    extra = best.groupBy("_id", "_digest").agg(F.array_sort(F.collect_list(F.struct(F.col("b.kind").alias("kind"), "start", "end"))).alias("extra"))
    joined = scanned.join(extra, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    return joined.select("doc_id", "digest", "base", F.coalesce("extra", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("extra"))


def digest_columns(found: DataFrame, kinds: tuple[str, ...] = KINDS, by_start: bool = False) -> DataFrame:
    """Counts per kind of the base spans, their digest, and all spans as one string."""
    place = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    order = (lambda s: F.struct(s.start.alias("a"), place[s.kind].alias("b"), s.end.alias("end"), s.kind.alias("kind"), s.start.alias("start"))) if by_start else (
        lambda s: F.struct(place[s.kind].alias("a"), s.start.alias("b"), s.end.alias("end"), s.kind.alias("kind"), s.start.alias("start")))
    text = lambda spans: F.array_join(F.transform(F.array_sort(F.transform(spans, order)), lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.concat("base", "extra")).alias("spans"))


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for value, marked in zip(batch.column(0), batch.column(1), strict=True):
            text, spans = value.as_py(), marked.as_py()
            if text is not None and spans:
                done, parts = 0, []
                for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                    if s["end"] <= done:
                        continue
                    if s["start"] >= done:
                        parts += [text[done:s["start"]], f"[{s['kind']}]"]
                    done = s["end"]
                text = "".join(parts) + text[done:]
            out.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(2)], names=["text", "row"])
        batch = out = None
        give_back()


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with every found span replaced by its kind in brackets; other rows pass as they are."""
    found = find_pii(docs).select("doc_id", "digest", F.concat("base", "extra").alias("spans")).where("size(spans) > 0")
    found = found.groupBy(F.col("doc_id").alias("id"), "digest").agg(F.first("spans").alias("spans"))
    rest = [c for c in docs.columns if c != "text"]
    row = F.struct(*rest)
    keyed = docs.select("text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), row.alias("row"))
    joined = keyed.join(found, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("digest")), "left").select("text", "spans", "row")
    done = joined.mapInArrow(_redact, f"text string, row {keyed.schema['row'].dataType.simpleString()}")
    return done.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
