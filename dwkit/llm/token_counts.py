"""Token counts of a sentence-piece BPE vocabulary with a whole-token shortcut.

Offline, once per vocabulary and Python worker (size bounded by the vocabulary):

* ``cuts``: the characters at which a text can be cut for certain.  No piece holds a space
  mark after another character, so no merge crosses the start of a run of spaces.
  Likewise ``breaks`` is the largest set of characters such that no piece holds one of them
  right after a character outside the set; no merge crosses such a place either.
* ``whole``: the vocabulary strings whose own merges end in one token.

In the tasks a text becomes pre-tokens by these cuts.  Those found in ``whole`` count one,
only the rest are merged (by score, leftmost first), with a bounded memo.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import Memo

MARK = "▁"  # fixed value of the format: stands for a space


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceBPE:
    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(lib.get_piece_size())
        self.scores = {lib.id_to_piece(i): lib.get_score(i) for i in ids
                       if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))}
        if any(MARK in s.lstrip(MARK) for s in self.scores):
            raise ValueError("this vocabulary has pieces across spaces")
        self.breaks = self._breaks()
        c = "".join(map(re.escape, sorted(self.breaks)))
        self.pre_token = re.compile(f"{MARK}*[^{MARK}{c}]+|{MARK}*[{c}][^{MARK}]*|{MARK}+" if c else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.whole = frozenset(s for s in self.scores if self.merged(s) == 1)
        self.memo = Memo(self.count_pre_token)

    def _breaks(self) -> set:
        found = {c for s in self.scores for c in s if not c.isalnum() and c != MARK}
        while True:
            bad = {b for s in self.scores for a, b in zip(s, s[1:]) if b in found and a not in found and a != MARK}
            if not bad:
                return found
            found -= bad

    def merged(self, s: str) -> int:
        """Tokens of one pre-token: the best-scored neighbours merge first; characters without a
        piece count one token for each of their bytes."""
        parts, scores = list(s), self.scores
        if len(parts) > 64:
            parts = self._merged_long(parts)
        else:
            none = float("-inf")
            pairs = [scores.get(a + b, none) for a, b in zip(parts, parts[1:])]
            while pairs and (best := max(pairs)) != none:
                i = pairs.index(best)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del pairs[i]
                if i:
                    pairs[i - 1] = scores.get(parts[i - 1] + parts[i], none)
                if i < len(pairs):
                    pairs[i] = scores.get(parts[i] + parts[i + 1], none)
        return sum(1 if p in scores else len(p.encode()) for p in parts)

    def _merged_long(self, parts: list) -> list:
        from heapq import heapify, heappop, heappush

        n, scores = len(parts), self.scores
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(-x, i, parts[i], parts[i + 1]) for i in range(n - 1) if (x := scores.get(parts[i] + parts[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, ""
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (x := scores.get(parts[i] + parts[k])) is not None:
                    heappush(heap, (-x, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (x := scores.get(parts[h] + parts[i])) is not None:
                heappush(heap, (-x, h, parts[h], parts[i]))
        return [p for p in parts if p]

    def count_pre_token(self, s: str) -> int:
        return 1 if s in self.whole else self.merged(s)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        found = self.pre_token.findall(MARK + text.replace(" ", MARK))
        return sum(map(self.memo.__getitem__, found))


@lru_cache(maxsize=2)
def load(path: str) -> PieceBPE:
    return PieceBPE(path)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = 4096) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit per row.

    Null text counts as empty: no bytes, no tokens.  Rows are independent: repeated rows and null
    ids stay, other columns are not read, no rows give no rows.
    """
    path = path or vocabulary_path()

    @F.pandas_udf("bigint")
    def n_tokens(s: pd.Series) -> pd.Series:
        vocabulary = load(path)
        return pd.Series([vocabulary.count(t) for t in s], dtype="int64")

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").alias(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                         n_tokens(text).alias("n_tokens"))
    return narrow.withColumn("over_limit", F.col("n_tokens") > limit)
