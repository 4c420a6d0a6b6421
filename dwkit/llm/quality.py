"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

* Terms of a text are its words, their shapes (runs of capitals, letters and digits, marks as they
  are), pairs of neighbouring shapes, and whether a word repeats the one before; all are hashed to
  ``TERMS`` buckets.  How many documents hold a bucket is counted over the whole corpus.
* A bounded sample of labelled texts gives a TF-IDF matrix; its leading right singular vectors are
  the latent space.  The driver sees the sample's bucket counts only.
* The labelled vectors (``max_per_class`` of each label, ``DIMENSIONS`` numbers each) are
  broadcast.  Every document is projected and compared with all of them in blocks of exact cosine
  products; its ``NEIGHBOURS`` nearest vote with their labels, weighted by similarity and, since
  the sample is drawn by label, by how many texts of its label a neighbour stands for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import Memo

TERMS = 4096
DIMENSIONS = 32
NEIGHBOURS = 15
SHARPNESS = 4
MAX_PER_CLASS = 3000
THRESHOLD = 0.3
BLOCK = 256
_SHAPE_CHARS = 12


def shape(word: str) -> str:
    """``Word`` -> ``Aa``, ``x1.5%`` -> ``a9.9%``: runs of one class as one mark, other characters as they are."""
    out = []
    for c in word[:64]:
        k = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if not out or k != out[-1] or k not in "Aa9":
            out.append(k)
    return "".join(out[:_SHAPE_CHARS])


class Terms:
    """Bucket counts of a text."""

    def __init__(self):
        # CRC of the word (low half) and of its shape (high half)
        self.codes = Memo(lambda w: zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) | zlib.crc32(shape(w).encode("utf-8", "surrogatepass")) << 32, 250_000)

    def counts(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if not words:
            return np.zeros(TERMS, dtype=np.int64)
        both = np.fromiter(map(self.codes.__getitem__, words), dtype=np.uint64, count=len(words))
        word, mark = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
        before = np.concatenate([np.zeros(1, dtype=np.uint64), mark[:-1]])
        pair = (before * np.uint64(0x9E3779B97F4A7C15) + mark * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
        again = np.concatenate([np.zeros(1, dtype=bool), word[1:] == word[:-1]]).astype(np.uint64)
        at = np.concatenate([word * np.uint64(2654435761) >> np.uint64(11), mark, pair, again]) % np.uint64(TERMS)
        return np.bincount(at.astype(np.int64), minlength=TERMS)


def is_held_out(id_col):
    """crc32 of the id as text has remainder 0 by 5 (null ids aren't held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_frequency(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """Texts that hold each bucket, and the number of texts, over the whole corpus."""
    def run(batches):
        terms, total = Terms(), np.zeros(TERMS + 1, dtype=np.int64)
        for pdf in batches:
            for t in pdf["text"]:
                total[:TERMS] += terms.counts(t) > 0
            total[TERMS] += len(pdf)
        yield pd.DataFrame({"bucket": np.arange(TERMS + 1), "n": total})

    rows = docs.select(F.col(f"`{text_col}`").alias("text")).mapInPandas(run, "bucket bigint, n bigint")
    got = dict(map(tuple, rows.groupBy("bucket").agg(F.sum("n")).collect()))  # at most TERMS + 1 rows
    return np.array([got.get(i, 0) for i in range(TERMS)], dtype=np.float64), int(got.get(TERMS, 0))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows of sqrt(count) * idf (rows of zeros stay)."""
    x = np.sqrt(counts).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), np.float32(1e-9))


def latent_space(x: np.ndarray, dimensions: int, rounds: int = 5) -> np.ndarray:
    """The leading right singular vectors of ``x``, by subspace iteration from a fixed start."""
    k = min(dimensions, *x.shape)
    q = np.random.default_rng(11).standard_normal((x.shape[1], min(k + 16, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    return np.ascontiguousarray((q @ np.linalg.svd(x @ q, full_matrices=False)[2].T)[:, :k])


class Model:
    """Everything a task needs; its size is bounded by the parameters."""

    def __init__(self, idf, space, vectors, labels, stands_for, neighbours):
        self.idf, self.space, self.vectors, self.labels, self.stands_for = idf, space, vectors, labels, stands_for
        self.neighbours = min(neighbours, len(labels))
        self.prior = float((labels * stands_for).sum() / stands_for.sum()) if len(labels) else 0.5

    def project(self, counts: np.ndarray) -> np.ndarray:
        e = weighted(counts, self.idf) @ self.space
        return e / np.maximum(np.linalg.norm(e, axis=1, keepdims=True), np.float32(1e-9))

    def vote(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors; the labels' mean where nothing is similar."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self.project(counts) @ self.vectors.T
        k = self.neighbours
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < cosine.shape[1] else np.broadcast_to(np.arange(k), (len(counts), k))
        near = np.sort(near, axis=1)
        w = np.clip(np.take_along_axis(cosine, near, 1).astype(np.float64), 0, 1) ** SHARPNESS * self.stands_for[near]
        total = w.sum(1)
        return np.clip(np.where(total > 0, (w * self.labels[near]).sum(1) / np.where(total > 0, total, 1), self.prior), 0, 1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_per_class: int = MAX_PER_CLASS, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> Model:
    """Latent space and labelled vectors from rows that aren't held out.  Null labels are no labels; of several labels
    of an id the mean counts (1 from 0.5 on).  Without a labelled text every score is 0.5."""
    df, n = document_frequency(docs, text_col)
    idf = (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)
    given = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    given = given.where(F.col("id").isNotNull() & ~is_held_out(F.col("id")))
    sizes = dict(map(tuple, given.groupBy("label").count().collect()))
    chosen = [given.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(max_per_class) for v in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * max_per_class rows of two numbers

    def run(batches):
        terms = Terms()
        for pdf in batches:
            counts = [terms.counts(t) for t in pdf["text"]]
            at = [np.flatnonzero(c) for c in counts]
            yield pd.DataFrame({"id": pdf["id"], "label": pdf["label"], "at": pd.Series(at, index=pdf.index, dtype=object),
                                "n": pd.Series([c[i] for c, i in zip(counts, at)], index=pdf.index, dtype=object)})

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one row an id, so the bound holds
    got = rows.mapInPandas(run, f"id {kind}, label int, at array<bigint>, n array<bigint>").toPandas().sort_values("id")
    x = np.zeros((len(got), TERMS), dtype=np.float32)
    for i, (at, n_at) in enumerate(zip(got["at"], got["n"])):
        x[i, np.asarray(at, dtype=np.int64)] = n_at
    y = got["label"].to_numpy(dtype=np.float64)
    stands_for = np.where(y == 1, sizes.get(1, 0) / max(1, (y == 1).sum()), sizes.get(0, 0) / max(1, (y == 0).sum()))
    if not len(got):
        return Model(idf, np.zeros((TERMS, 1), dtype=np.float32), np.zeros((0, 1), dtype=np.float32), y, stands_for, neighbours)
    model = Model(idf, latent_space(weighted(x, idf), dimensions), np.zeros((0, 1), dtype=np.float32), y, stands_for, neighbours)
    model.vectors = model.project(x)
    return model


def scores(docs: DataFrame, model: Model, text_col: str = "text"):
    """Column: share of label 1 that a text's neighbours vote for.  Null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms, m = Terms(), shared.value
        for s in batches:
            texts = s.tolist()
            parts = [m.vote(np.stack([terms.counts(t) for t in texts[i:i + BLOCK]])) for i in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return run(F.col(f"`{text_col}`"))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, held_out, score, predicted per row.

    Labels of held-out ids are never read; ids, languages and sources are no inputs of a score.
    Null and empty texts get the labels' mean; repeated rows are scored each, null ids stay (not held
    out); other columns aren't read; no rows give no rows.
    """
    model = train(docs, labels, id_col, text_col, **options)
    key = F.col(f"`{id_col}`")
    return docs.select(key.alias(id_col), is_held_out(key).alias("held_out"), scores(docs, model, text_col).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
