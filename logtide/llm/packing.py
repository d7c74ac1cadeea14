"""Tokenising and packing: bounded-space online best fit."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from logtide.llm.common import give_back

SEQUENCE = 4096
END_ID = 1
OPEN_BINS = 1024
#: Bytes of cached words and ids, and what one entry takes beside its characters and ids.
CACHED_BYTES, ENTRY_BYTES = 160 << 20, 180
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class BestFit:
    """Open bins by free space: a bitset of the free spaces in use and the bins of each.

    A piece goes to the fullest bin that takes it. When none does, a new bin opens; if ``most`` are open already, the
    fullest closes first. So memory is bounded whatever the number of pieces.
    """

    def __init__(self, size: int = SEQUENCE, most: int = OPEN_BINS):
        self.size, self.most = size, most
        self.bits, self.bins, self.open, self.made = 0, {}, 0, 0

    def _pop(self, free: int) -> int:
        bins = self.bins[free]
        at = bins.pop()
        if not bins:
            del self.bins[free]
            self.bits ^= 1 << free
        self.open -= 1
        return at

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it of a piece of ``length``, 1 to ``size``."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = self._pop(free)
        else:
            if self.open >= self.most:
                self._pop((self.bits & -self.bits).bit_length() - 1)
            free, at = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.bins.setdefault(left, []).append(at)
            self.bits |= 1 << left
            self.open += 1
        return at, self.size - free


class WordTokenizer:
    """Ids of texts by a tokenizer file whose merges stay inside white space, chunk by chunk from a bounded cache.

    The word pattern is applied here to texts of ASCII and Latin letters up to U+017F, where normalisation only lowers
    case; every other text, and any that may name a special token, goes to the tokenizer whole.
    """

    # The word pattern of the tokenizer file, for lower-cased text up to U+017F.
    LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffĀ-ž"
    NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
    BLANK = "\\t-\\r \x85\xa0"
    PATTERN = f"[{LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+"
    PLAIN = "[\x00-\x1b!-~ \xa1-\xd6\xd8-įı-ňŊ-ž\xd7]*"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        # One tokenizer, used in three ways: as its file says, without normalising (chunks come lower-cased), and split at blanks alone.
        self.tokenizer = Tokenizer.from_file(path)
        given = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        bare = normalizers.Sequence([])
        blanks = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ways = {"given": given, "whole": (bare, given[1]), "words": (bare, blanks)}
        self.split, self.plain, self.cache, self.held = re.compile(self.PATTERN).findall, re.compile(self.PLAIN).fullmatch, {}, 0
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def _use(self, way: str):
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.ways[way]
        return self.tokenizer

    def _keep(self, chunk: str, ids: bytes) -> None:
        self.cache[chunk] = ids
        self.held += ENTRY_BYTES + len(chunk) + len(ids)

    def _learn(self, chunks: list[str]) -> None:
        """Caches the ids of chunks. A word with one mark behind it takes those of the word and of the mark."""
        tails = [c for c in chunks if c[-1] in ".," and c[:-1].isalpha()]
        words = {c for c in chunks if c.isalpha()}
        words.update(w for c in tails if (w := c[:-1]) not in self.cache)
        tailed = set(tails)
        self._encode("words", list(words))
        self._encode("whole", [".", ",", *(c for c in chunks if c not in words and c not in tailed)])
        for c in tails:
            self._keep(c, self.cache[c[:-1]] + self.cache[c[-1]])

    def _encode(self, way: str, chunks: list[str]) -> None:
        """Encodes chunks together and cuts their ids where a word's last token ends, as many words as each chunk has."""
        tokenizer = self._use(way)
        for lo in range(0, len(chunks), 4096):
            part = chunks[lo:lo + 4096]
            lines = [" ".join(part[k:k + 64]) for k in range(0, len(part), 64)]
            ids = np.array([i for e in tokenizer.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], "<u4")
            ends = np.nonzero(self.ends[ids])[0] + 1
            words = np.arange(1, len(part) + 1) if way == "words" else np.cumsum([len(self.split(c)) for c in part])
            raw, start = ids.tobytes(), 0
            for c, stop in zip(part, (4 * ends[words - 1]).tolist(), strict=True):
                self._keep(c, raw[start:stop])
                start = stop

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > CACHED_BYTES:
            self.cache.clear()
            self.held = 0
        chunks = [None if "<|" in t or not self.plain(t) else t.lower().split() for t in texts]
        fresh = set()
        for c in chunks:
            fresh.update(c or ())
        self._learn([c for c in fresh if c not in self.cache])
        known, tokenizer = self.cache.__getitem__, self._use("given")
        return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4") if c is None
                else np.frombuffer(b"".join(map(known, c)), "<u4") for t, c in zip(texts, chunks, strict=True)]


def _pack(path: str, size: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, bins = WordTokenizer(path), BestFit(size, most)
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            docs = batch.column(0)
            for lo in range(0, batch.num_rows, 256):
                pieces = []
                for k, ids in enumerate(tokens.ids([t.as_py() or "" for t in batch.column(1).slice(lo, 256)])):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4", copy=False)
                    for p, start in enumerate(range(0, len(ids), size)):
                        part = ids[start:start + size]
                        pieces.append((lo + k, p, start, len(part), zlib.crc32(part.tobytes())))
                pieces.sort(key=lambda x: -x[3])
                placed = [bins.place(x[3]) for x in pieces]
                at = pa.array([x[0] for x in pieces], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    docs.take(at), pa.array([x[1] for x in pieces], pa.int32()), *[pa.array([x[i] for x in pieces], pa.int64()) for i in (2, 3, 4)],
                    pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
            give_back()
        tokens = bins = None
        give_back()
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE,
         open_bins: int = OPEN_BINS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every token of every document in one sequence.

    Each task packs the documents of its partition as they come (256 at a time, longest first) with at most ``open_bins``
    open sequences, so nothing is shuffled; the price is the room left in the sequences open at a task's end.

    Null text counts as empty; an empty document is its end mark alone. Longer documents than ``size`` are cut into pieces,
    only the last of which may be shorter. Repeated rows are packed each. Null ids stay null. Empty tables give no rows.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_pack(tokenizer, size, open_bins), PIECES)
