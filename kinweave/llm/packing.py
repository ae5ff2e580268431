"""Best-fit packing of token pieces into sequences, with a bounded number of open sequences.

Every document is tokenised whole; an end-of-document id is put after it; only documents longer than
a sequence are cut.  A piece goes to the open sequence with the least free space that holds it.  The
open sequences stand in stacks by free space, and a bitset has a bit for each free space that
occurs, so the best fit is the lowest set bit at or above the piece's length.  When no open sequence
holds the piece and the bound is reached, the fullest one closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

END = 1
#: White space to Python's str.split() and none to the tokenizer's ``\\s``.
_ODD_SPACES = "\x1c\x1d\x1e\x1f"
_PIECES = "row long, piece int, start long, length long, ids_crc32 long, ids array<int>"


class Words:
    """Ids of texts, as little-endian unsigned 32-bit bytes, by a tokenizer that never looks across white space.

    The tokenizer replaces white space, splits there and merges within what is left, so a text's ids
    are those of its space-separated parts in a row.  Parts recur, so their ids are kept, for
    ``room`` parts at most.  A part of letters and one final stop or comma is the letters' ids and
    the mark's.  Latin letters, which have one form and one lower case each, go straight to the
    tokenizer's merges.  Texts with the four separators that the two notions of white space
    disagree on go to the tokenizer whole.
    """

    def __init__(self, path: str, room: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.room = Tokenizer.from_file(path), room
        self.known: dict[str, bytes] = {}
        # The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.byte = {b: chr(b) if b in own else chr(next(other)) for b in range(256)}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _keep(self, part: str, ids: bytes) -> bytes:
        if len(part) <= 64:
            if len(self.known) >= self.room:
                self.known.clear()
            self.known[part] = ids
        return ids

    def _bare(self, text: str) -> bytes:
        if not (text.isalpha() and (text.isascii() or max(text) < "\u0130")):
            return self._encode(text)
        text = text.lower()
        got = self.known.get(text)
        if got is None:
            merged = self.tokenizer.model.tokenize(text if text.isascii() else "".join([self.byte[b] for b in text.encode()]))
            got = self._keep(text, b"".join([x.id.to_bytes(4, "little") for x in merged]))
        return got

    def _part(self, part: str) -> bytes:
        if part[-1] in ".," and part[:-1].isalpha():
            return self._keep(part, self._bare(part[:-1]) + (self.known.get(part[-1]) or self._keep(part[-1], self._encode(part[-1]))))
        return self._keep(part, self._bare(part))

    def ids(self, text: str) -> bytes:
        if any(x in text for x in _ODD_SPACES):
            return self._encode(text)
        known, part = self.known.get, self._part
        return b"".join([known(x) or part(x) for x in text.split()])


@lru_cache(2)
def _words(path: str) -> Words:
    """One for each Python worker, which serves many tasks."""
    return Words(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """A row a piece: row, doc_id, piece, start, length, ids_crc32 (and ids, if asked for).

    ``docs`` has doc_id and text; other columns are not looked at.  A null text counts as empty: its
    one piece is the end id.  Rows with equal doc_id are packed each for itself and told apart by
    ``row``, a number without meaning that is fixed once the result is written.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _words(tokenizer)
        end, wide = END.to_bytes(4, "little"), 4 * capacity
        for batch in texts:
            out = []
            for text in batch:
                ids = words.ids(text) + end
                out.append([
                    {"piece": k, "start": at // 4, "length": len(x) // 4, "ids_crc32": zlib.crc32(x), "ids": np.frombuffer(x, "<u4").astype(np.int32) if with_ids else None}
                    for k, at in enumerate(range(0, len(ids), wide)) for x in [ids[at : at + wide]]
                ])
            yield pd.Series(out)

    kind = "array<struct<piece: int, start: long, length: long, ids_crc32: long, ids: array<int>>>"
    got = numbered.withColumn("p", F.explode(F.pandas_udf(cut, kind)("text")))
    return got.select("row", "doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", *["p.ids"] * with_ids)


class OpenBins:
    """Best fit among at most ``room`` open sequences; ``place`` returns (sequence, offset)."""

    def __init__(self, capacity: int, room: int) -> None:
        self.capacity, self.room = capacity, room
        self.bits, self.open, self.made = 0, 0, 0
        self.stacks: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        out = stack.pop()
        if not stack:
            del self.stacks[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return out

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            where = self._take(free)
        else:
            if self.open >= self.room and length < self.capacity:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, where = self.capacity, self.made
            self.made += 1
        if left := free - length:
            self.stacks.setdefault(left, []).append(where)
            self.bits |= 1 << left
            self.open += 1
        return where, self.capacity - free


def packed(parts: DataFrame, capacity: int = 4096, room: int = 16384, tokens_per_task: int = 1 << 26, batch: int = 16384) -> DataFrame:
    """``parts`` (columns row, piece, length and any others) with ``sequence_id`` and ``offset``.

    Pieces are dealt out by a hash, one task for each ``tokens_per_task`` tokens.  A task takes
    pieces in batches of about ``batch`` and the longest of a batch first, so that short ones fill
    up what long ones leave; it holds ``room`` open sequences and nothing else.  Each task leaves
    its last open sequences as they are.  An empty table gives an empty one.
    """
    total, n = parts.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    tasks = max(1, -(-total // tokens_per_task))
    batches = max(1, -(-n // (tasks * batch)))
    deal = F.xxhash64("row", "piece")
    dealt = parts.select("row", "piece", "length").withColumn("deal", deal).repartition(tasks, "deal")
    dealt = dealt.withColumn("batch", F.pmod(F.shiftright("deal", 20), F.lit(batches))).sortWithinPartitions("batch", F.desc("length"), "deal", "row", "piece")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, base = OpenBins(capacity, room), TaskContext.get().partitionId() << 40
        for df in batches:
            got = [bins.place(n) for n in df["length"].tolist()]
            yield pd.DataFrame({"row": df["row"], "piece": df["piece"], "sequence_id": [base + s for s, _ in got], "offset": [o for _, o in got]})

    placed = dealt.mapInPandas(pack, "row long, piece int, sequence_id long, offset long")
    return parts.join(placed, ["row", "piece"])


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, room: int = 16384, tokens_per_task: int = 1 << 26, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): all of ``docs``, packed."""
    parts = written(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    return packed(parts, capacity, room, tokens_per_task).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)
