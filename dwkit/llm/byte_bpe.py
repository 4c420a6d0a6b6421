"""Byte-level BPE as a bounded-lookahead streaming transducer, and its inverse.

``MergeTable.lookahead`` is computed from the merge list (see there): however a text goes on,
tokens that end more than that many bytes before the end of what has been read are final.
``StreamEncoder`` therefore keeps one window of bytes, emits what is stable and forgets it;
``StreamDecoder`` is the inverse machine, ids to bytes to text.

Texts are cut into pieces at white space that follows other characters.  No pre-token of the
vocabulary's pattern crosses such a place, so a piece's tokens do not depend on its neighbours
and a bounded memo of pieces saves repeated work.  Everything here runs inside one task on
one text at a time.
"""

from __future__ import annotations

import codecs
import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import regex

# Fixed values of the vocabulary's format: the pre-token pattern and the byte alphabet.
PRE_TOKEN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
PIECE = re.compile(r"\s*\S+|\s+")
#: No pre-token crosses these places, whatever a character table takes for white space beyond the plain kinds.
PIECE_END = re.compile(r"(?<=\S)(?=[ \t\n\r])")
#: Characters that the library's character tables may class differently: such texts take its own splitter.
UNSURE = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\x9f\\xa1-ɏ‐-‧€Α-Ωα-ωА-я]")
BLOCK_CHARS = 1 << 16
MEMO_SIZE = 700_000
LONG_KEY = 64
WINDOW_BYTES = 4096


def byte_alphabet() -> dict[str, int]:
    """Character -> byte: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Memo(dict):
    """Bounded memo: emptied when full, so that memory stays constant."""

    def __init__(self, fn, size: int = MEMO_SIZE):
        self.fn, self.size = fn, size

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) > LONG_KEY:
            return value
        if len(self) >= self.size:
            self.clear()
        self[key] = value
        return value


class MergeTable:
    """Vocabulary bytes, pair ranks, and the lookahead that suffices for stable tokens."""

    def __init__(self, vocab: dict[str, int], merges: list, special: dict[str, int]):
        alphabet = byte_alphabet()
        self.special = special
        self.token_bytes = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items() if s not in special}
        self.of_byte = [0] * 256
        for i, b in self.token_bytes.items():
            if len(b) == 1:
                self.of_byte[b[0]] = i
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(merges):
            left, right = m if isinstance(m, (list, tuple)) else m.split(" ")
            self.ranks.setdefault((vocab[left], vocab[right]), (r, vocab[left + right]))
        self.lookahead = self._sufficient_lookahead()
        self.longest = max(map(len, self.token_bytes.values()))

    def _sufficient_lookahead(self) -> int:
        """Bytes after which the rest of a text can no longer move a token boundary.

        Take two texts with n common bytes and compare them after each merge rule.  At first
        all boundaries up to n agree.  The first differing boundary moves left only when a rule
        (u, v) applies in one text where v covers that boundary; it then lies between u and v,
        at most |v| further left.  Later rules (u', v') move it on only if v' starts where u
        does, that is if u is on the left spine of v', and then by |u|.  The longest such chain
        in rank order bounds the total.
        """
        size = {i: len(b) for i, b in self.token_bytes.items()}
        made: dict[int, int] = {}   # token -> left part of the rule that makes it
        reach: dict[int, int] = {}  # token u -> best chain that ends in a rule (u, .), plus |u|
        most = 1
        for (u, v), (_, new) in sorted(self.ranks.items(), key=lambda x: x[1][0]):
            best, s = size[v], v
            while s is not None:
                best = max(best, reach.get(s, 0))
                s = made.get(s)
            most = max(most, best)
            reach[u] = max(reach.get(u, 0), best + size[u])
            made.setdefault(new, u)
        return most

    def merge(self, data: bytes) -> list[int]:
        """Tokens of ``data``: lowest rank first, leftmost first among equals."""
        ids = [self.of_byte[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        ranks = self.ranks
        if n <= 48:
            get, none = ranks.get, (len(ranks), -1)
            found = [get(p, none) for p in zip(ids, ids[1:])]
            while found and (best := min(found)) is not none:
                at, new = found.index(best), best[1]
                ids[at:at + 2] = [new]
                del found[at]
                if at:
                    found[at - 1] = get((ids[at - 1], new), none)
                if at < len(found):
                    found[at] = get((new, ids[at + 1]), none)
            return ids
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(n - 1) if (r := ranks.get((ids[i], ids[i + 1])))]
        heapify(heap)
        while heap:
            _, i, a, b, new = heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if r := ranks.get((new, ids[k])):
                    heappush(heap, (r[0], i, new, ids[k], r[1]))
            h = before[i]
            if h >= 0 and (r := ranks.get((ids[h], new))):
                heappush(heap, (r[0], h, ids[h], new, r[1]))
        return [t for t in ids if t >= 0]


class StreamEncoder:
    """Transducer for the bytes of one pre-token, fed in parts; ``feed`` returns stable tokens."""

    def __init__(self, table: MergeTable, window: int = WINDOW_BYTES):
        self.table, self.window, self.held = table, window, b""

    def feed(self, data: bytes) -> list[int]:
        self.held += data
        out: list[int] = []
        room = self.window + self.table.lookahead + self.table.longest
        while len(self.held) >= room:
            part, end, stable = self.held[:room], 0, []
            for t in self.table.merge(part):
                if end + len(self.table.token_bytes[t]) > room - self.table.lookahead - 1:
                    break
                end += len(self.table.token_bytes[t])
                stable.append(t)
            out += stable
            self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        out, self.held = self.table.merge(self.held), b""
        return out


class StreamDecoder:
    """Ids to text in parts; bytes of an unfinished character wait for the next part."""

    def __init__(self, codec: "ByteBPE"):
        self.bytes_of, self.text = codec.bytes_of, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.text.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.text.decode(b"", True)


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.path = path
        self.table = MergeTable(spec["model"]["vocab"], spec["model"]["merges"], special)
        self.special = regex.compile("|".join(sorted(map(regex.escape, special), key=len, reverse=True))) if special else None
        self.bytes_of = self.table.token_bytes | {i: s.encode() for s, i in special.items()}
        self.pre_tokens = Memo(self._pre_token)
        self.pieces = Memo(self._piece)
        self._library = None

    def _pre_token(self, s: str) -> tuple:
        return tuple(self.table.merge(s.encode()))

    def _piece(self, s: str) -> tuple:
        found = PRE_TOKEN.findall(s)
        return self.pre_tokens[s] if len(found) == 1 else tuple(chain.from_iterable(map(self.pre_tokens.__getitem__, found)))

    def _spans(self, text: str, unsure: bool):
        """Places of the pre-tokens; for characters of uncertain class the library's own splitter cuts."""
        if not unsure:
            return (m.span() for m in PRE_TOKEN.finditer(text))
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return (span for _, span in self._library.pre_tokenize_str(text))

    def _streamed(self, text: str, unsure: bool):
        """Yield lists of token tuples; a long pre-token's tokens leave as soon as they are stable."""
        out = []
        for a, b in self._spans(text, unsure):
            if b - a <= WINDOW_BYTES // 4:
                out.append(self.pre_tokens[text[a:b]])
                if len(out) < BLOCK_CHARS // 4:
                    continue
            yield out
            out = []
            if b - a > WINDOW_BYTES // 4:
                stream = StreamEncoder(self.table)
                for i in range(a, b, WINDOW_BYTES // 4):
                    if stable := stream.feed(text[i:min(b, i + WINDOW_BYTES // 4)].encode()):
                        yield [tuple(stable)]
                yield [tuple(stream.finish())]
        yield out

    def blocks(self, text: str):
        """Yield lists of token tuples, block by block; joined they are the tokens of ``text``."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[at:m.start()])
            yield [(self.table.special[m.group()],)]
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str):
        if not text:
            return
        unsure, at, n = bool(UNSURE.search(text)), 0, len(text)
        while at < n:
            end = n
            if n - at > BLOCK_CHARS and (m := PIECE_END.search(text, at + BLOCK_CHARS)):
                end = m.start()
            if unsure or end - at > 2 * BLOCK_CHARS:  # the latter: hardly any white space
                yield from self._streamed(text[at:end], unsure)
            else:
                yield list(map(self.pieces.__getitem__, PIECE.findall(text, at, end)))
            at = end

    def encode(self, text: str) -> list[int]:
        return [t for block in self.blocks(text) for ids in block for t in ids]


@lru_cache(maxsize=4)
def load(path: str) -> ByteBPE:
    """One codec per Python worker."""
    return ByteBPE(path)
