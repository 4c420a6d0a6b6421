"""Importance resampling towards a target distribution, ranked by parallel sorting by regular sampling.

*Weights.*  Texts become hashed runs of words (word and pair buckets).  Bucket counts of the whole
corpus and of the whole target are summed in Spark from one array per task; they give an array
of one gain a bucket, and a text's weight is the floored mean of the gains at its features.
A pair's CRC follows from those of its words (the CRC of a joined string is linear in the
first part), so only distinct words are ever hashed byte by byte.

*Ranks.*  Documents with a score and its noise form runs, one for each task, sorted and written to the shared
folder.  Every w-th row of every run is a sample; the sorted samples give p - 1 regular
splitters.  A row's segment follows from the splitters, segments are exchanged and merged by
a local sort, and the segments' sizes, summed in order, turn the place in a segment into the exact rank.
Segments wholly beyond the draw aren't exchanged.  With r runs a segment holds at most N / p + r w rows.

Only bucket counts (``BUCKETS`` rows), samples (about p * p, p at most ``MAX_SEGMENTS``) and
segment sizes (p rows) reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .byte_bpe import Memo

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
MAX_SEGMENTS = 512
BLOCK_CHARS = 1 << 20
PLACE = (1 << 33) - 1  # the part of monotonically_increasing_id() that counts inside a partition
LAST_ID = (1 << 63) - 1

#: Word characters are digits, a-z and everything beyond ASCII; A-Z is lower-cased, the rest separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_LONGEST = 255  # words up to this many bytes have a shift table


def _shift_tables() -> np.ndarray:
    """[n, k, v]: what byte k of a CRC, of value v, becomes when n bytes follow."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> np.uint32(1)), step >> np.uint32(1))
    now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [now]
    for _ in range(_LONGEST):
        now = (now >> np.uint32(8)) ^ step[now & np.uint32(255)]
        out.append(now)
    return np.stack(out)


class Features:
    """Bucket numbers of the words and word pairs of a block of texts."""

    def __init__(self):
        # a word's own CRC (low half) and that of the word and a space (high half)
        self.crcs = Memo(lambda w: zlib.crc32(w) | zlib.crc32(w + b" ") << 32, 300_000)
        self.tables = _shift_tables()

    def block(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, number of the text in the block) of all features."""
        found = [(t or "").encode("utf-8", "surrogatepass").translate(_FOLD).split() for t in texts]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        words = [w for x in found for w in x]
        if not words:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        both = np.fromiter(map(self.crcs.__getitem__, words), dtype=np.uint64, count=len(words))
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = np.repeat(np.arange(len(texts)), sizes)
        own, spaced = both.astype(np.uint32), (both >> np.uint64(32)).astype(np.uint32)
        second = np.flatnonzero(text[1:] == text[:-1]) + 1
        x, n = spaced[second - 1], np.minimum(lengths[second], _LONGEST)
        pair = own[second].copy()
        for k in range(4):
            pair ^= self.tables[n, k, (x >> np.uint32(8 * k)) & np.uint32(255)]
        for i in np.flatnonzero(lengths[second] > _LONGEST):
            pair[i] = zlib.crc32(words[second[i]], int(x[i]))
        return np.concatenate([own, pair]).astype(np.int64) % BUCKETS, np.concatenate([text, text[second]])


def _blocks(texts):
    """Slices of about BLOCK_CHARS characters."""
    start = chars = 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= BLOCK_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def bucket_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features in each bucket over all texts; tasks send one row a bucket, Spark adds them."""
    def run(batches):
        features, total = Features(), np.zeros(BUCKETS, dtype=np.int64)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in _blocks(texts):
                total += np.bincount(features.block(texts[a:b])[0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    rows = docs.select(F.col(f"`{text_col}`").alias("text")).where(F.col("text").isNotNull()).mapInPandas(run, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of the target's share of a bucket to the corpus's."""
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def noise(key: str) -> int:
    """Fixed Gumbel noise of a document, in thousandths."""
    u = (int(hashlib.sha256(f"{SEED}:{key}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
    return math.floor(-1000 * math.log(-math.log(u)))


def score(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_features, weight, score of every row, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # BUCKETS numbers

    def run(batches):
        features, gain = Features(), shared.value
        for pdf in batches:
            texts, n, total = pdf["text"].tolist(), np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
            for a, b in _blocks(texts):
                buckets, text = features.block(texts[a:b])
                n[a:b] = np.bincount(text, minlength=b - a)
                total[a:b] = np.bincount(text, weights=gain[buckets], minlength=b - a)  # exact below 2^53
            weight = np.floor_divide(total, np.maximum(n, 1))
            yield pd.DataFrame({"id": pdf["id"], "n_features": n, "weight": weight,
                                "score": weight + np.fromiter(map(noise, pdf["key"]), dtype=np.int64, count=len(pdf))})

    key = F.col(f"`{id_col}`").cast("long")
    narrow = docs.select(key.alias("id"), F.coalesce(key.cast("string"), F.lit("")).alias("key"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInPandas(run, "id bigint, n_features bigint, weight bigint, score bigint")


def _segment_of(splitters: np.ndarray, spark):
    """Column function: number of splitters (score, id) that come before a row, scores falling, ids rising."""
    shared = spark.sparkContext.broadcast(splitters)

    @F.pandas_udf("int")
    def segment(s: pd.Series, i: pd.Series) -> pd.Series:
        cut = shared.value
        lo, hi = np.zeros(len(s), dtype=np.int64), np.full(len(s), len(cut), dtype=np.int64)
        a, b = s.to_numpy(), i.to_numpy()
        while (open_ := lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(cut) - 1)
            before = open_ & ((cut[mid, 0] > a) | ((cut[mid, 0] == a) & (cut[mid, 1] <= b)))
            lo, hi = np.where(before, mid + 1, lo), np.where(open_ & ~before, mid, hi)
        return pd.Series(lo.astype(np.int32))

    return segment(F.col("score"), F.col("tie"))


def rank_top(scored: DataFrame, draw_percent: int = PERCENT, least_features: int = 2 * LEAST_WORDS - 1) -> DataFrame:
    """``scored`` (id, n_features, weight, score) and rank: 1, 2, 3... of the floor(draw_percent * N / 100)
    highest scores among the N rows with at least ``least_features`` features; null for the others."""
    spark = scored.sparkSession
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE))
    runs = scored.withColumn("eligible", F.col("n_features") >= least_features).withColumn("tie", F.coalesce("id", F.lit(LAST_ID)))
    runs = runs.sortWithinPartitions(F.desc("eligible"), F.desc("score"), "tie").withColumn("at", inside)
    runs = materialize(runs, "importance-runs")
    able = runs.where("eligible")
    n = able.count()
    p = max(1, min(MAX_SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    stride = max(1, n // (p * p))
    samples = able.where(F.col("at") % stride == stride // 2).select("score", "tie").toPandas()
    samples = samples.sort_values(["score", "tie"], ascending=[False, True]).to_numpy(dtype=np.int64).reshape(-1, 2)
    splitters = samples[[len(samples) * k // p for k in range(1, p)]] if len(samples) else samples
    segment = _segment_of(splitters, spark)
    sizes = {r["segment"]: r["count"] for r in able.groupBy(segment.alias("segment")).count().collect()}  # at most p rows
    draw = draw_percent * n // 100
    starts = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(p)])])[:p].tolist()
    last = sum(s < draw for s in starts)  # later segments lie beyond the draw
    out = ["id", "n_features", "weight", "score"]
    segments = runs.withColumn("segment", F.when(F.col("eligible"), segment))
    rest = segments.where(~F.coalesce(F.col("segment") < last, F.lit(False))).select(*out, F.lit(None).cast("long").alias("rank"))
    if not last:
        return rest
    offsets = F.broadcast(spark.createDataFrame(list(enumerate(starts[:last])), "segment int, start long"))
    top = segments.where(F.col("segment") < last).repartitionById(last, "segment").sortWithinPartitions(F.desc("score"), "tie")
    top = top.withColumn("place", inside).join(offsets, "segment").withColumn("rank", F.col("start") + F.col("place") + 1)
    return top.select(*out, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank")).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             draw_percent: int = PERCENT) -> DataFrame:
    """id, n_features, weight, score, rank of every row of ``docs``, resampled towards ``target``.

    Null and empty texts have no features, weight 0 and no rank.  Ids are integers; a null id counts
    as empty text in the noise and comes last among ties.  Repeated rows are drawn separately, in any order among
    themselves.  An empty target gives weights from smoothing alone; no rows give no rows.  Other columns aren't read.
    """
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    return rank_top(score(docs, gains, id_col, text_col), draw_percent).withColumnRenamed("id", id_col)
