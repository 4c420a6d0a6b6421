"""Alignment of two tokenizers over every text: which tokens of one cover which of the other.

1. Documents are shuffled by their full text; each distinct text goes on once, with its multiplicity.
2. A task cuts a text at spaces that follow another character.  No pre-token of the byte-level
   vocabulary and no piece of the sentence-piece vocabulary crosses such a place, so both
   tokenizers encode the parts alone, those unknown to a bounded memo in batches.  Between two
   neighbouring ends of tokens of either kind lies one link; an end of both kinds ends a group.
   A text's measures, its distinct linked id pairs and how often each occurs are written once to the shared folder.
3. A pair's count is the summed multiplicity of the texts that hold it: tasks add up their
   texts, Spark adds the tasks.  The largest count of each A id is an array bounded by the vocabulary.
4. The most frequent pairs, ``HOT_PAIRS`` at most, are broadcast as two arrays and looked up next to the
   texts; pairs below their least count are joined by shuffle (each of them is rare).
5. Measures come back to the documents by the text's SHA-256.  Texts that make up at least one row in
   ``HOT_TEXTS`` are at most that many and are broadcast; the rest join by shuffle.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .byte_bpe import byte_alphabet

HOT_PAIRS = 1 << 21
HOT_TEXTS = 1024
FLUSH = 1 << 19  # linked pairs that a task holds before it adds them up
BLOCK_TEXTS = 64
MEMO_PARTS, LONG_PART = 450_000, 64
CUT = re.compile(r"(?<=\S)(?= )")
_BYTE = re.compile("<0x([0-9A-F]{2})>")
MARK = "▁"  # fixed value of the format: stands for a space


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Both tokenizers and the ids of the parts seen so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet, vocab = byte_alphabet(), self.a.get_vocab(with_added_tokens=True)
        bytes_a = {i: bytes(alphabet[c] for c in s) if all(c in alphabet for c in s) else s.encode() for s, i in vocab.items()}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if max(len(self.bytes_a), len(pieces)) > 0x10000:
            raise ValueError("a pair of ids must fit into 32 bits")
        if any(MARK in s.lstrip(MARK) for s in pieces):
            raise ValueError("this vocabulary has pieces across spaces")
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(s)) else s.replace(MARK, " ").encode() for s in pieces]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        # an id and the mark after it: within a group, between its halves, between groups
        self.marked = [f"{i}{c}".encode() for i in range(max(len(self.bytes_a), len(pieces))) for c in ",|;"]
        self.space = self.b.piece_to_id(MARK)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def encode_parts(self, parts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """16-bit ids of parts that start with a space (which the second tokenizer puts there by itself);
        None where a tokenizer loses bytes.

        Parts that end in no white space can follow each other as they do in texts, so they are encoded as one text
        and its ids are dealt out by their bytes; if that text's bytes are lost, and for other parts, each is encoded alone.
        """
        data = [p.encode() for p in parts]
        ends = np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))
        if len(parts) > 1:
            text = "".join(parts)
            ids_a, ids_b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:])
            sides = []
            for ids, of in ((ids_a, self.bytes_a), (ids_b, self.bytes_b)):
                token = list(map(of.__getitem__, ids))
                if b"".join(token) != b"".join(data):
                    break
                until = np.searchsorted(np.cumsum(np.fromiter(map(len, token), dtype=np.int64, count=len(token))), ends) + 1
                flat, at = array("H", ids).tobytes(), [0, *(2 * until).tolist()]
                sides.append([flat[i:j] for i, j in zip(at, at[1:])])
            else:
                return list(zip(*sides))
        out = []
        for part, whole in zip(parts, data):
            a = self.a.encode(part, add_special_tokens=False).ids
            b = self.b.encode(part[1:]) if len(part) > 1 else [self.space]
            same = b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
            out.append((array("H", a).tobytes(), array("H", b).tobytes()) if same else None)
        return out

    def encode_texts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers for whole texts (None: no tokens)."""
        cut = [CUT.split(" " + t) if t else [] for t in texts]
        known, new = self.known, set(chain.from_iterable(cut)).difference(self.known)
        alone = [p for p in new if p[-1].isspace()]  # such a part ends its text
        known.update(zip(alone, chain.from_iterable(self.encode_parts([p]) for p in alone)))
        rest = list(new.difference(alone))
        known.update(zip(rest, self.encode_parts(rest)))
        out = []
        for parts in cut:
            found = list(map(known.__getitem__, parts))
            if not found or None in found:
                out.append(None)
                continue
            a, b = zip(*found)
            out.append((np.frombuffer(b"".join(a), dtype=np.uint16).astype(np.int64), np.frombuffer(b"".join(b), dtype=np.uint16).astype(np.int64)))
        if len(known) > MEMO_PARTS:
            known.clear()
        else:
            for p in new:
                if len(p) > LONG_PART:
                    del known[p]
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs, their occurrences) of a text's ids."""
        end_a, end_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        last_a, last_b = end_b[np.searchsorted(end_b, end_a)] == end_a, end_a[np.searchsorted(end_a, end_b)] == end_b  # both end at the text's end
        ends = np.sort(np.concatenate([end_a, end_b[~last_b]]), kind="stable")  # every end once: each closes a link
        pairs = a[np.searchsorted(end_a, ends)] << 16 | b[np.searchsorted(end_b, ends)]
        # a token's place in the text of the groups: its own kind before it, and the other kind of earlier groups
        # (for tokens of b also of its own group)
        until_a, until_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        marked = np.empty(len(a) + len(b), dtype=np.int64)
        marked[np.arange(len(a)) + np.concatenate([[0], until_b])[group_a]] = a * 3 + last_a
        marked[np.arange(len(b)) + until_a[group_b]] = b * 3 + 2 * last_b
        text = b"".join(map(self.marked.__getitem__, marked.tolist()))
        distinct, often = np.unique(pairs, return_counts=True)
        return len(a), len(b), len(until_a), len(ends), hashlib.sha256(text[:-1]).hexdigest(), distinct.astype(np.uint32), often.astype(np.uint32)

    def align_texts(self, texts: list[str | None]):
        """``align`` of every text, block by block; zeros for texts without tokens."""
        none = np.empty(0, dtype=np.uint32)
        for i in range(0, len(texts), BLOCK_TEXTS):
            for ids in self.encode_texts([t or "" for t in texts[i:i + BLOCK_TEXTS]]):
                yield (0, 0, 0, 0, "", none, none) if ids is None else self.align(*ids)


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Aligner:
    """One aligner per Python worker."""
    return Aligner(path_a, path_b)


def pack_links(pairs: np.ndarray, often: np.ndarray) -> bytes:
    """Distinct rising pairs and their occurrences as compressed gaps, byte plane by byte plane."""
    if not len(pairs):
        return b""
    gaps = np.diff(pairs, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(np.stack([gaps, often.astype("<u4")]).view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes(), 1)


def unpack_links(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(2, 4, -1).transpose(0, 2, 1)
    gaps, often = np.ascontiguousarray(raw).view("<u4")[:, :, 0].astype(np.int64)
    return np.cumsum(gaps), often


def align_texts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Measures and packed links of each row of ``texts`` (key, text, n), written once."""
    kinds = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                       ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary())])

    def run(batches):
        aligner = load(path_a, path_b)
        for batch in batches:
            for i in range(0, batch.num_rows, 4 * BLOCK_TEXTS):  # few texts at a time are Python strings
                part = batch.slice(i, 4 * BLOCK_TEXTS)
                rows = [(*got[:5], pack_links(*got[5:])) for got in aligner.align_texts(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("key").cast(pa.binary()), part.column("n"),
                                                  *[pa.array(x, kinds.field(k + 2).type) for k, x in enumerate(zip(*rows))]], schema=kinds)

    return materialize(texts.mapInArrow(run, "key binary, n bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                             "groups_sha256 string, links binary"), "alignment-links")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold an id pair linked; a text counts as often as it occurs."""
    def run(batches):
        load.cache_clear()  # a reused worker needs no tokenizers here
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def added():
            pairs, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return pairs, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        for pdf in batches:
            for data, n in zip(pdf["links"], pdf["n"]):
                pairs, _ = unpack_links(data)
                held.append((pairs, np.full(len(pairs), n)))
                size += len(pairs)
                if size >= FLUSH:
                    held = [added()]
                    size = len(held[0][0])
                    if size >= FLUSH // 2:
                        yield pd.DataFrame({"pair": held[0][0], "n": held[0][1]})
                        held, size = [], 0
        if held:
            pairs, n = added()
            yield pd.DataFrame({"pair": pairs, "n": n})

    rows = links.select("links", "n").where(F.length("links") > 0).mapInPandas(run, "pair bigint, n bigint")
    return materialize(rows.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")


def least_hot_count(counts: DataFrame, hot_pairs: int) -> int:
    """The smallest power of two from which on at most ``hot_pairs`` pairs count."""
    by = dict(map(tuple, counts.groupBy(F.floor(F.log2("n") + 1e-9).alias("power")).count().collect()))  # at most 64 rows
    total, power = 0, max(by, default=0) + 1
    while power > 0 and total + by.get(power - 1, 0) <= hot_pairs:
        power -= 1
        total += by.get(power, 0)
    return 1 << power


def corpus_measures(links: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """key, n and measures of each text, with n_best and count_sum from the pair counts of the whole corpus."""
    spark = links.sparkSession
    counts = pair_counts(links)
    best = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("most"))  # at most 65,536 rows
    most = np.zeros(1 << 16, dtype=np.int64)
    for r in best.collect():
        most[r["a"]] = r["most"]
    least = least_hot_count(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toPandas().sort_values("pair")  # at most hot_pairs rows of two numbers
    shared = spark.sparkContext.broadcast((hot["pair"].to_numpy(dtype=np.int64), hot["n"].to_numpy(dtype=np.int64), most))

    def run(batches):
        load.cache_clear()  # a reused worker needs no tokenizers here
        known, n_of, top = shared.value
        for pdf in batches:
            rows = []
            for data in pdf["links"]:
                pairs, often = unpack_links(data)
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                found = known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
                n = n_of[at[found]]
                rows.append((int(often[found][n == top[pairs[found] >> 16]].sum()), int((often[found] * n).sum()), pairs[~found], often[~found]))
            out = pd.DataFrame(rows, columns=["n_best", "count_sum", "cold", "cold_often"], index=pdf.index)
            yield pd.concat([pdf.drop(columns="links"), out], axis=1)

    kept = ["key", "n", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = ("key binary, n bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
              "n_best bigint, count_sum bigint, cold array<bigint>, cold_often array<bigint>")
    near = materialize(links.select(*kept, "links").mapInPandas(run, schema), "alignment-measures")
    rest = near.where(F.size("cold") > 0).select("key", F.explode(F.arrays_zip("cold", "cold_often")).alias("x"))
    rest = rest.select("key", F.col("x.cold").alias("pair"), F.col("x.cold_often").alias("often"))
    rest = rest.join(counts.where(F.col("n") < least), "pair").withColumn("a", F.shiftright("pair", 16)).join(F.broadcast(best), "a")
    rest = rest.groupBy("key").agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("often")).otherwise(0)).alias("cold_best"),
                                   F.sum(F.col("often") * F.col("n")).alias("cold_sum"))
    out = near.drop("cold", "cold_often").join(rest, "key", "left")
    return out.select(*kept, (F.col("n_best") + F.coalesce("cold_best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("cold_sum", F.lit(0))).alias("count_sum"))


def align_tokenizers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                     path_b: str | None = None, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row.

    Null and empty texts, and texts of which a tokenizer loses bytes, have no tokens: zeros and an empty digest.
    Equal texts are aligned once and counted as often as they occur; repeated rows and null ids stay, other columns
    aren't read, no rows give no rows.
    """
    default = vocabulary_paths()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    key = F.unhex(F.sha2("text", 256)).alias("key")
    texts = rows.groupBy("text").agg(F.count("*").alias("n")).select(key, "text", "n")
    links = align_texts(texts, path_a or default[0], path_b or default[1])
    measures = materialize(corpus_measures(links, hot_pairs), "alignment-texts")
    total = measures.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    hot = measures.where(F.col("n") * HOT_TEXTS >= total).select("key", F.struct(*names).alias("often"))  # at most HOT_TEXTS rows
    cold = measures.where(F.col("n") * HOT_TEXTS < total).select("key", F.lit(0).alias("spread"), F.struct(*names).alias("once"))
    # rows that have their measures already are spread by id, so that no key of the second join is hot
    found = rows.select("id", key).join(F.broadcast(hot), "key", "left").withColumn(
        "spread", F.when(F.col("often").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int")))
    found = found.join(cold, ["key", "spread"], "left").select(F.col("id").alias(id_col), F.coalesce("often", "once").alias("m"))
    return found.select(f"`{id_col}`", *[F.col(f"m.{c}").alias(c) for c in names])
