"""Secrets: exact base patterns, and strings that a dictionary-primed compressor cannot shorten."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtide.session import written

KINDS = ("assign", "access", "hex")
#: The base patterns; the least length of group 2, or of the match.
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
NOVELTY = "novelty"
#: Words that make a place sensitive.
SENSITIVE = re.compile(r"passw|passphrase|secret|token|api|key|credential|auth|bearer|private|signature|login|pwd", re.IGNORECASE | re.ASCII)
_long = re.compile(r"[A-Za-z0-9+/_.=-]{16,}").finditer
_word = re.compile(r"[_./-]*(?:[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*)[0-9]{0,2}[_./-]+").match
_part = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])").finditer
_vowels = re.compile(r"[aeiouy]", re.IGNORECASE).findall
_hard = re.compile(r"[^aeiouy]{5}", re.IGNORECASE).search
_hexes = re.compile(r"[0-9a-f]{16,}").finditer
CONTEXT = 96
NEAR = 48
LEAST = 16


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches by start, then kind as listed; code points, end exclusive, of the whole match. Failing ones are dropped.

    Runs of hexadecimal digits that are long enough are the only ones that count, so shorter ones are not looked at.
    """
    out = []
    for kind, (pattern, group, least) in PATTERNS.items():
        if kind == "hex":
            out += [(m.start(), 2, m.end(), kind) for m in _hexes(text)]
        elif kind != "access" or "AKIA" in text:
            out += [(m.start(), KINDS.index(kind), m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def _name(value: str) -> bool:
    """Whether it can be a made-up name or key rather than a word: a digit, or a capital inside."""
    return any(c.isdigit() for c in value) or any(c.isupper() for c in value[1:])


def _value_start(text: str, start: int, end: int) -> int:
    """Where the value starts after leading words as in ``private_key_x``: after the last sensitive one of them, if 16 characters stay."""
    value, at = start, start
    while (word := _word(text, at, end)) and end - word.end() >= LEAST:
        at = word.end()
        if SENSITIVE.search(word[0]):
            value = at
    return value


def pieces(text: str) -> Iterator[tuple[int, int, int]]:
    """``(name, start, end)`` of the strings of 16 characters or more that can be a value; ``name`` is where its name starts.

    A run is cut at each '=' that is no padding at its end: of ``DB_PWD=x`` or ``?signature=x`` the value is ``x`` and the
    name what stands before it. A run without a part of 16 characters stays whole.
    """
    for m in _long(text):
        parts, start = [(m.start(), m.start())], m.start()
        end = start + len(m[0].rstrip("="))
        while 0 <= (cut := text.find("=", start, end)):
            parts.append((start, cut + 1))
            start = cut + 1
        ends = [start - 1 for _, start in parts[1:]] + [m.end()]
        whole = True
        for (name, start), end in zip(parts, ends, strict=True):
            if end - start >= LEAST:
                whole = False
                yield name, _value_start(text, start, end), end
        if whole:
            yield m.start(), m.start(), m.end()


def _wordy(value: str) -> bool:
    """Whether at least five of six letters and digits are in parts that can be words, and 0.3 of them are vowels; a part is three letters
    or more in one case or with one capital first, a vowel among them, no more than four consonants in a row."""
    size = sum(c.isalnum() for c in value)
    parts = [p for m in _part(value) if _vowels(p := m[0]) and not _hard(p)]
    return 6 * sum(map(len, parts)) >= 5 * size and 10 * sum(len(_vowels(p)) for p in parts) >= 3 * size


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Strings of 16 characters or more with a sensitive word in their name or near them, that no base match touches,
    with the text around them."""
    out = []
    for name, start, end in pieces(text):
        value = text[start:end]
        if any(s < end and start < e for _, s, e in base):
            continue
        if not _name(value):
            continue
        if SENSITIVE.search(text, min(name, max(0, start - NEAR)), start) or SENSITIVE.search(text, end, end + NEAR):
            before, after = text[max(0, start - CONTEXT - len(value)):start], text[end:end + CONTEXT + len(value)]
            if not _wordy(value):  # copies close by must not make it cheap
                blank = " " * len(value)
                before, after = before.replace(value, blank), after.replace(value, blank)
            around = before[-CONTEXT:] + after[:CONTEXT]
            out.append({"value": value, "around": around, "start": start, "end": end})
    return out


def names_in(text: str, base: list[tuple[str, int, int]], found: list[dict]) -> set[str]:
    """Long names made of words that the text holds outside base matches, and nowhere as a candidate."""
    names = {text[s:e] for _, s, e in pieces(text) if _name(text[s:e]) and _wordy(text[s:e])}
    return names - {text[s:e] for _, s, e in base} - {f["value"] for f in found}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    item = pa.struct([("value", pa.string()), ("around", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        base, found, names = [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            spans = base_spans(text)
            base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
            found.append(candidates(text, spans))
            names.append(sorted(names_in(text, spans, found[-1])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(base, pa.list_(span)), pa.array(found, pa.list_(item)), pa.array(names, pa.list_(pa.string()))],
            names=["doc_id", "digest", "base", "found", "names"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: base spans, candidates with their surroundings, and long names made of words in the text."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("digest"))
    return picked.mapInArrow(_scan, "doc_id long, digest string, base array<struct<kind:string,start:int,end:int>>, "
                                    "found array<struct<value:string,around:string,start:int,end:int>>, names array<string>")


def identifier_dictionary(scanned: DataFrame, size: int = 2000, texts: int = 3) -> bytes:
    """The ``size`` long names that the most different texts hold, the commonest last, where a compressor finds them best.

    Counted over all rows: per name the distinct digests of the texts, so exact copies of one text count once (near copies
    count each). Only names made of words count, in texts where they stand in no sensitive place; so neither a random
    string nor a value that stands in sensitive places alone becomes part of it, however many texts hold it.
    """
    pairs = scanned.select("digest", F.explode("names").alias("name")).distinct()
    top = pairs.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= texts).orderBy(F.desc("n"), "name").limit(size).collect()
    return "\n".join(r.name for r in reversed(top)).encode()[-(1 << 16):]


def marginal_bytes(value: str, around: str, dictionary: bytes) -> int:
    """Compressed bytes that ``value`` adds to its surroundings, for a compressor that has the dictionary at hand."""
    import zstandard

    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
    press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False)
    context = around.encode("utf-8", "surrogatepass")
    return len(press.compress(context + b"\n" + value.encode())) - len(press.compress(context + b"\n"))


def _judge(dictionary: bytes, novelty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            extra = []
            for found in batch.column(3).to_pylist():
                kept = [f for f in found or () if marginal_bytes(f["value"], f["around"], dictionary) >= novelty * len(f["value"])]
                extra.append([{"kind": NOVELTY, "start": f["start"], "end": f["end"]} for f in kept])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(extra, pa.list_(span))], names=["doc_id", "digest", "base", "extra"])
    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", novelty: float = 0.7, names: int = 2000) -> DataFrame:
    """``doc_id, digest, base, extra`` for every row: exact base spans, and novel strings in sensitive places.

    A candidate is reported if its marginal compressed size is at least ``novelty`` bytes per character: random base-64
    text needs 0.75 and more, words and paths that the surroundings or the dictionary repeat need far less. A reused secret
    is reported at each of its places: it is not in the dictionary, and its copies are not among its surroundings.

    Null text counts as empty and has no spans. Repeated rows are judged each, alike. Null ids stay null. Empty tables
    give no rows; other columns are not read.
    """
    scanned = written(scan(docs, id_col, text_col), "scanned")
    dictionary = identifier_dictionary(scanned, names)
    return scanned.select("doc_id", "digest", "base", "found").mapInArrow(
        _judge(dictionary, novelty), "doc_id long, digest string, base array<struct<kind:string,start:int,end:int>>, extra array<struct<kind:string,start:int,end:int>>")
