"""Hierarchical packing of token streams into windows of several lengths.

Each task reads its documents once, tokenises them and packs them, without a shuffle of texts or ids:

1. *Route.*  A document gives full windows of the longest tier as often as it can.  The rest
   goes to the queue of the smallest tier that holds it (tiers 1024, 512, 256 by default).
2. *Pack each tier.*  A tier whose queue exceeds ``reserve`` tokens packs windows of its own length, the shortest
   tier first: the longest queued piece opens a window.
3. *Fill gaps.*  The gap of a window is filled from shorter tiers, then from its own, best fit first: the
   largest queued piece that fits whole, again and again; the last piece is cut to the gap's
   exact size and its remainder queued in the tier that holds it.
4. *Leftovers.*  When a task ends, what is still queued (at most the reserve of each tier) is laid
   end to end and cut into full windows, then into ever shorter powers of two, so that
   no window needs padding.
5. *Step groups.*  Tasks know where a window starts in their own tokens; with the tasks' totals, summed in order,
   that is its place in the run, and every ``step_tokens`` tokens make a group.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import byte_bpe

TIERS = (1024, 512, 256)
QUEUE_TOKENS = 1 << 20
MEMO_SIZE = 250_000  # pieces; a miss costs little here, and workers keep the memo
STEP_TOKENS = 1 << 16
TASK_BITS = 36  # of a sequence id, below its task's number
PIECE_COLUMNS = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
                 "`offset` bigint, tier int, step_group bigint")


class Codec:
    """Text -> little-endian 32-bit ids as the library gives them, one memo per worker."""

    def __init__(self, path: str, end_id: int):
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_bpe.byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.by_ranks = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.unsure = re.compile("|".join([byte_bpe.UNSURE.pattern, *map(re.escape, special)]))
        self.pieces = byte_bpe.Memo(self._piece, MEMO_SIZE)
        self.end = struct.pack("<I", end_id)

    def _piece(self, s: str) -> bytes:
        ids = self.by_ranks.encode_ordinary(s)
        return struct.pack(f"<{len(ids)}I", *ids)

    def document(self, text: str | None) -> bytes:
        text = text or ""
        if self.unsure.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids) + self.end
        return b"".join(map(self.pieces.__getitem__, byte_bpe.PIECE.findall(text))) + self.end


@lru_cache(maxsize=2)
def codec(path: str, end_id: int) -> Codec:
    return Codec(path, end_id)


class Packer:
    """Packing state of one task: queued pieces by length, tokens queued in each tier, windows made so far."""

    def __init__(self, first_id: int, tiers=TIERS, queue_tokens: int = QUEUE_TOKENS, step_tokens: int = STEP_TOKENS):
        self.tiers = sorted(tiers)
        self.first_id, self.step_tokens = first_id, step_tokens
        self.reserve = max(queue_tokens // len(self.tiers), 2 * self.tiers[-1])
        self.made = self.tokens = 0                                   # windows, and tokens in windows, so far
        self.queue: list[list] = [[] for _ in range(self.tiers[-1])]  # pieces by length
        self.lengths = 0                                              # bit mask of the lengths that are queued
        self.queued = [0] * len(self.tiers)                           # tokens by tier
        self.out: list[tuple] = []

    def tier_of(self, length: int) -> int:
        return bisect_left(self.tiers, length)

    def window(self, pieces: list, size: int) -> None:
        sid, start, at = self.first_id + self.made, self.tokens, 0
        for doc, first, length, n, ids in pieces:
            self.out.append((doc, first, length, zlib.crc32(ids), n, sid, at, size, start // self.step_tokens, start))
            at += length
        self.made += 1
        self.tokens += at

    def put(self, piece: tuple) -> None:
        length = piece[2]
        if length in self.tiers:
            self.window([piece], length)
            return
        self.queue[length].append(piece)
        self.lengths |= 1 << length
        self.queued[self.tier_of(length)] += length

    def pop(self, length: int) -> tuple:
        piece = self.queue[length].pop()
        if not self.queue[length]:
            self.lengths &= ~(1 << length)
        self.queued[self.tier_of(length)] -= length
        return piece

    def take(self, room: int) -> tuple:
        """The longest queued piece of at most ``room`` tokens; else the shortest longer one, cut to ``room``."""
        fit = self.lengths & ((2 << room) - 1)
        if fit:
            return self.pop(fit.bit_length() - 1)
        part, rest = self.cut(self.pop((self.lengths & -self.lengths).bit_length() - 1), room)
        self.put(rest)
        return part

    @staticmethod
    def cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
        doc, start, length, n, ids = piece
        return (doc, start, at, n, ids[:4 * at]), (doc, start + at, length - at, n, ids[4 * at:])

    def fill(self, size: int) -> None:
        """A window of ``size`` tokens from the queues, which hold as many."""
        pieces, room = [], size
        while room:
            pieces.append(self.take(room))
            room -= pieces[-1][2]
        self.window(pieces, size)

    def add(self, doc, ids: bytes) -> None:
        """One document: its full windows leave at once, its rest is routed."""
        n, top = len(ids) // 4, self.tiers[-1]
        view = memoryview(ids)
        for at in range(0, n - top + 1, top):
            self.window([(doc, at, top, n, view[4 * at:4 * (at + top)])], top)
        rest = n % top
        if rest:
            self.put((doc, n - rest, rest, n, ids[4 * (n - rest):]))
        for k, size in enumerate(self.tiers):
            while self.queued[k] > self.reserve:
                self.fill(size)

    def finish(self) -> None:
        """Full windows of every tier as long as its pieces last, then decreasing powers of two."""
        for k, size in reversed(list(enumerate(self.tiers))):
            while sum(self.queued) >= size and (self.queued[k] or k == 0):
                self.fill(size)
        while left := sum(self.queued):
            self.fill(1 << (left.bit_length() - 1))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 0,
         tiers=TIERS, queue_tokens: int = QUEUE_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    A document is its token ids and ``end_id``; null text counts as empty, so every row gives at
    least one piece.  Rows are packed as they come: repeated rows are packed each, null
    ids stay null, other columns are not read, no rows give no pieces.  Tiers are powers of two.
    Sequence ids are unique (task number in the high bits); a task's memory is bounded by
    ``queue_tokens``, one batch of rows and the memo.  Pieces are written once, as step groups need the tasks' totals.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if any(t & (t - 1) for t in tiers) or len(tiers) < 2:
        raise ValueError("tiers must be two powers of two at least")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "at"]

    def run(batches):
        from pyspark import TaskContext

        tokens = codec(path, end_id)
        state = Packer(TaskContext.get().partitionId() << TASK_BITS, tiers, queue_tokens, step_tokens)

        def frame():
            out = pd.DataFrame(state.out, columns=names)
            state.out = []
            return out

        for pdf in batches:
            for doc, text in zip(pdf["id"].tolist(), pdf["text"]):
                state.add(doc, tokens.document(text))
            if state.out:
                yield frame()
        state.finish()
        if state.out:
            yield frame()

    pieces = materialize(narrow.mapInPandas(run, f"id {kind}, {PIECE_COLUMNS}, at bigint"), "packing-pieces")
    task = F.shiftright("sequence_id", TASK_BITS)
    totals = pieces.groupBy(task.alias("_task")).agg(F.sum("length").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = F.broadcast(totals.select("_task", before.alias("_before")))  # a row a task
    placed = pieces.join(totals, task == F.col("_task")).withColumn("step_group", F.floor((F.col("_before") + F.col("at")) / step_tokens).cast("long"))
    return placed.select(F.col("id").alias(id_col), *[f"`{c}`" for c in names[1:-1]])
