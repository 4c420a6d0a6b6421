"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and texts taken without a label (U: all that aren't held out, a mixture with a
known share ``prior`` of toxic ones) train a linear classifier.  Everything is counted over all rows of P and U; the
driver sees sums whose size the parameters bound.

* Features are hashed words and word beginnings, present or absent in a text.  The ``CANDIDATES`` most
  frequent of P are counted in U too; those that P holds more often than U's share explains (likelihood ratio
  beyond what chance gives the best of all candidates), the ``MAX_FEATURES`` surest of them, are kept.
* A text becomes the vector of its kept features; equal vectors are counted once, and what follows reads their table.
* First and second moments of these features in P and U determine the non-negative risk
  prior R+(P) + max(0, R-(U) - prior R-(P))  with the squared loss; weights minimise it.  When the
  corrected negative part falls below zero the step goes against it, which keeps a flexible model from
  fitting the unlabelled texts away.
* Margins of P and U as histograms then give slope and bias of a logistic score, under the same risk
  with the logistic loss.

Only confirmed texts are joined with labels.  Scoring covers every whole text in one pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bitmaps import Bitmap
from .shingles import shingle_set

CANDIDATES = 1 << 15
MAX_FEATURES = 256
FLUSH = 1 << 20   # features that a task holds before it adds them up
MARGIN_BINS = 1 << 15
FILTER_BITS = 1 << 24  # bits of the id filter (2 MB), whatever the number of labels
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
GAP = re.compile(r"[\W\d_]")
BLOCK_ROWS = 256        # texts whose features a task marks at once
BLOCK_CHARS = 1 << 19   # characters whose words a task holds at once, but for one long word
LONG_WORD = 64          # bytes; the rest of a longer word is hashed by itself


def word_features(word: str) -> tuple:
    """Hashes of a word and of its beginnings."""
    marked = "^" + word
    return (zlib.crc32((marked + "$").encode()), *(zlib.crc32(marked[:n + 1].encode()) for n in BEGINNINGS if len(word) >= n))


def is_held_out(id_col):
    """crc32 of the id as text has remainder 2 by 4 (null ids aren't held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@lru_cache(1)
def _letters() -> np.ndarray:
    """By code point, whether a word may hold it."""
    out = np.zeros(0x110000, dtype=bool)
    for m in WORD.finditer("".join(map(chr, range(len(out))))):
        out[m.start():m.end()] = True
    return out


@lru_cache(1)
def _crc_table() -> np.ndarray:
    """State of a crc32 after one byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


def _pieces(texts: Sequence) -> Iterator[tuple[int, str]]:
    """(row, lower-case text) in pieces of about BLOCK_CHARS characters at most, cut between words."""
    for row, t in enumerate(texts):
        t, at = (t or "").lower(), 0
        while len(t) - at > BLOCK_CHARS:
            gap = GAP.search(t, at + BLOCK_CHARS)
            end = gap.start() if gap else len(t)
            yield row, t[at:end]
            at = end
        yield row, t[at:]


def _hash_words(rows: list, parts: list) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all words of some pieces, as ``word_features`` gives them: a crc32 moves on by one byte of every word at once."""
    joined = "\n".join(parts)
    raw = joined.encode("utf-8", "surrogatepass")
    data, table = np.frombuffer(raw, dtype=np.uint8), _crc_table()
    code = data if len(raw) == len(joined) else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = np.zeros(len(code) + 1, dtype=np.int64)  # first byte of every character
    np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), out=at[1:])
    letter = np.concatenate([[False], _letters()[code], [False]])
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    start, end = edges[::2], edges[1::2]
    size = at[end] - at[start]
    order = np.argsort(np.minimum(size, LONG_WORD + 1).astype(np.uint8), kind="stable")[::-1]  # longest first: words that go on come before those that ended
    start, end, size = start[order], end[order], size[order]
    first, chars, rising = at[start], end - start, np.minimum(size[::-1], LONG_WORD)
    row = np.asarray(rows, dtype=np.int64)[np.searchsorted(np.cumsum([0] + [len(p) + 1 for p in parts[:-1]]), start, "right") - 1]
    state = np.full(len(start), zlib.crc32(b"^") ^ 0xFFFFFFFF, dtype=np.uint32)
    ends = [np.where(chars >= n, at[np.minimum(start + n, end)] - first, 0) for n in BEGINNINGS]
    heads = [np.zeros(len(start), dtype=np.uint32) for _ in BEGINNINGS]
    for k in range(int(rising[-1]) if len(rising) else 0):
        m = len(rising) - int(np.searchsorted(rising, k, "right"))  # words of more than k bytes
        state[:m] = table[(state[:m] ^ data[first[:m] + k]) & 0xFF] ^ (state[:m] >> 8)
        if k < 4 * max(BEGINNINGS):
            for e, h in zip(ends, heads):
                done = np.flatnonzero(e[:m] == k + 1)
                h[done] = state[done]
    full = table[(state ^ ord("$")) & 0xFF] ^ (state >> 8)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        full[i] = zlib.crc32(raw[first[i]:first[i] + size[i]] + b"$", zlib.crc32(b"^")) ^ 0xFFFFFFFF
    has = [np.flatnonzero(chars >= n) for n in BEGINNINGS]
    return np.concatenate([row, *(row[x] for x in has)]), np.concatenate([full, *(h[x] for h, x in zip(heads, has))]) ^ np.uint32(0xFFFFFFFF)


def _features(texts: Sequence) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of all words of some texts, repeats included, in blocks."""
    rows, parts, size = [], [], 0
    for row, part in _pieces(texts):
        rows.append(row)
        parts.append(part)
        size += len(part)
        if size >= BLOCK_CHARS:
            yield _hash_words(rows, parts)
            rows, parts, size = [], [], 0
    if size:
        yield _hash_words(rows, parts)


def _places(texts: Sequence, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place in the rising array ``wanted``) of every distinct wanted feature of a text, by row and place, in blocks."""
    wanted = wanted.astype(np.uint32)
    low = np.uint32((1 << 22) - 1)
    may = np.zeros(1 << 22, dtype=bool)  # by lowest bits; the rest is searched
    may[wanted & low] = True
    for begin in range(0, len(texts), BLOCK_ROWS):
        some = texts[begin:begin + BLOCK_ROWS]
        held = np.zeros(len(some) * len(wanted), dtype=bool)
        for row, f in _features(some):
            at = np.flatnonzero(may[f & low])
            row, f = row[at], f[at]
            place = np.minimum(np.searchsorted(wanted, f), len(wanted) - 1)
            ok = wanted[place] == f
            held[row[ok] * len(wanted) + place[ok]] = True
        row, place = np.divmod(np.flatnonzero(held), max(len(wanted), 1))
        yield row + begin, place


def _rows_of(texts: Sequence, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted features of all texts, and where every text's places begin (and the last ones end)."""
    blocks = [*_places(texts, wanted)] or [(np.empty(0, dtype=np.int64),) * 2]
    return np.concatenate([p for _, p in blocks]), np.searchsorted(np.concatenate([r for r, _ in blocks]), np.arange(len(texts) + 1))


def count_features(texts: DataFrame, wanted=None) -> DataFrame:
    """(f, n): texts that hold each feature, of the rising broadcast array ``wanted`` only if given."""
    def run_all(batches):
        held, size = [], 0
        for pdf in batches:
            for begin in range(0, len(pdf), BLOCK_ROWS):
                found = [np.unique(row << 32 | f) for row, f in _features(pdf["text"].tolist()[begin:begin + BLOCK_ROWS])]
                found = np.unique(np.concatenate(found or [np.empty(0, dtype=np.int64)])) & 0xFFFFFFFF
                held.append(found)
                size += len(found)
                if size >= FLUSH:
                    f, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pd.DataFrame({"f": f, "n": n})
                    held, size = [], 0
        if size:
            f, n = np.unique(np.concatenate(held), return_counts=True)
            yield pd.DataFrame({"f": f, "n": n})

    def run_wanted(batches):
        total = np.zeros(len(wanted.value), dtype=np.int64)
        for pdf in batches:
            for _, place in _places(pdf["text"].tolist(), wanted.value):
                total += np.bincount(place, minlength=len(total))
        some = np.flatnonzero(total)
        yield pd.DataFrame({"f": wanted.value[some], "n": total[some]})

    return texts.select("text").mapInPandas(run_all if wanted is None else run_wanted, "f bigint, n bigint").groupBy("f").agg(F.sum("n").alias("n"))


def surest_features(k_p: np.ndarray, n_p: int, k_u: np.ndarray, n_u: int) -> np.ndarray:
    """Indices of at most MAX_FEATURES features that P holds more often than U's share explains, by their likelihood
    ratio, which must exceed what the best of so many chance features reaches."""
    u = (k_u + 0.5) / (n_u + 1.0)
    p = np.clip(k_p / n_p, 1e-12, 1 - 1e-12)
    ratio = 2 * (k_p * np.log(p / u) + (n_p - k_p) * np.log((1 - p) / np.maximum(1 - u, 1e-12)))
    ratio = np.where(p > u, ratio, 0.0)
    best = np.argsort(-ratio, kind="stable")[:MAX_FEATURES]
    return np.sort(best[ratio[best] > max(8.0, 2 * np.log(max(len(k_p), 1)))])


def vectors(texts: DataFrame, kept: np.ndarray) -> DataFrame:
    """(v, n): every distinct vector of kept features (their rising 16-bit places) and the texts that have it, written once."""
    def run(batches):
        held = Counter()
        for pdf in batches:
            place, at = _rows_of(pdf["text"].tolist(), kept)
            raw, at = place.astype(np.uint16).tobytes(), (2 * at).tolist()
            held.update(raw[i:j] for i, j in zip(at, at[1:]))
            if len(held) > FLUSH // 16:
                yield pd.DataFrame({"v": list(held), "n": list(held.values())})
                held.clear()
        if held:
            yield pd.DataFrame({"v": list(held), "n": list(held.values())})

    return materialize(texts.select("text").mapInPandas(run, "v binary, n bigint").groupBy("v").agg(F.sum("n").alias("n")), "toxicity-vectors")


def _matrix(pdf: pd.DataFrame, size: int) -> np.ndarray:
    """Rows of 0/1 features and a last column of ones."""
    x = np.zeros((len(pdf), size))
    x[:, -1] = 1
    at = [np.frombuffer(v, dtype=np.uint16) for v in pdf["v"]]
    x[np.repeat(np.arange(len(at)), list(map(len, at))), np.concatenate(at or [np.empty(0, dtype=np.uint16)]).astype(np.int64)] = 1
    return x


def moments(table: DataFrame, size: int) -> np.ndarray:
    """Sums of products of any two features (the last is constant) over all texts of a vector table."""
    def run(batches):
        total = np.zeros((size, size))
        for pdf in batches:
            for i in range(0, len(pdf), 4096):
                part = pdf.iloc[i:i + 4096]
                x = _matrix(part, size)
                total += (x * part["n"].to_numpy(dtype=float)[:, None]).T @ x
        yield pd.DataFrame({"i": np.arange(size), "row": [r.tobytes() for r in total]})

    def add(pdf):
        row = np.sum([np.frombuffer(r) for r in pdf["row"]], axis=0)
        return pd.DataFrame({"i": [int(pdf["i"].iloc[0])], "row": [row.tobytes()]})

    out = np.zeros((size, size))
    for r in table.mapInPandas(run, "i int, row binary").groupBy("i").applyInPandas(add, "i int, row binary").collect():  # MAX_FEATURES + 1 rows
        out[r["i"]] = np.frombuffer(bytes(r["row"]))
    return out


def fit_moments(m_p: np.ndarray, m_u: np.ndarray, prior: float, rounds: int = 800, rate: float = 0.02, ridge: float = 0.01) -> np.ndarray:
    """Weights (the last is the bias) that minimise the non-negative risk with the squared loss, from mean products of P and U."""
    one_p, one_u, shrink = m_p[:, -1], m_u[:, -1], np.full(len(m_p), ridge)
    shrink[-1] = 1e-6
    w = np.zeros(len(m_p))
    m, v = np.zeros(len(m_p)), np.zeros(len(m_p))
    for t in range(1, rounds + 1):
        corrected = (1 + 2 * one_u @ w + w @ m_u @ w) - prior * (1 + 2 * one_p @ w + w @ m_p @ w)
        as_positive = 2 * prior * (m_p @ w - one_p)
        as_negative = 2 * (one_u + m_u @ w) - 2 * prior * (one_p + m_p @ w)
        grad = (as_positive + as_negative if corrected >= 0 else -as_negative) + 2 * shrink * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def margins(table: DataFrame, w: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Histogram of the margins of all texts of a vector table between ``edges``."""
    def run(batches):
        total = np.zeros(len(edges) - 1)
        for pdf in batches:
            for i in range(0, len(pdf), 4096):
                part = pdf.iloc[i:i + 4096]
                f = np.clip(_matrix(part, len(w)) @ w, edges[0], edges[-1])
                total += np.histogram(f, edges, weights=part["n"].to_numpy(dtype=float))[0]
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bin": some, "n": total[some].astype(np.int64)})

    out = np.zeros(len(edges) - 1)
    for r in table.mapInPandas(run, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect():  # MARGIN_BINS rows at most
        out[r["bin"]] = r["n"]
    return out


def fit_margins(h_p: np.ndarray, h_u: np.ndarray, centers: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and bias of the logistic score of a margin."""
    n = len(centers)
    w, b = fit_nnpu(np.arange(2 * n), np.zeros(2 * n, dtype=np.int64), np.arange(2 * n) < n, 1, prior, rounds=4000, rate=0.05,
                    values=np.concatenate([centers, centers]), shares=np.concatenate([h_p / max(h_p.sum(), 1), h_u / max(h_u.sum(), 1)]), match_prior=False)
    return float(w[0]), b


def fit_nnpu(rows: np.ndarray, columns: np.ndarray, is_p: np.ndarray, n_features: int, prior: float, rounds: int = 600,
             rate: float = 0.1, ridge: float = 1e-4, values: np.ndarray | None = None, shares: np.ndarray | None = None,
             match_prior: bool = True) -> tuple[np.ndarray, float]:
    """Weights and bias under the non-negative risk with the logistic loss, for a sparse matrix (``rows``, ``columns`` of its
    entries, ones unless ``values`` are given); ``is_p`` marks rows of P.  ``shares`` are the rows' shares of P and of U
    (equal ones by default).  With ``match_prior`` the bias is set last, so that the mean score of U is the prior."""
    n = len(is_p)
    values = np.ones(len(rows)) if values is None else values
    shares = np.where(is_p, 1 / max(is_p.sum(), 1), 1 / max((~is_p).sum(), 1)) if shares is None else shares
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, rounds + 1):
        x = np.bincount(rows, weights=w[columns] * values, minlength=n) + b
        prob = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        minus = np.logaddexp(0, x) * shares           # loss of calling it negative
        corrected = minus[~is_p].sum() - prior * minus[is_p].sum()
        as_positive = np.where(is_p, prior * (prob - 1), 0) * shares
        as_negative = np.where(is_p, -prior * prob, prob) * shares
        g = as_positive + as_negative if corrected >= 0 else -as_negative
        grad = np.append(np.bincount(columns, weights=g[rows] * values, minlength=n_features) + ridge * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    if match_prior:
        x, low, high = np.bincount(rows, weights=w[columns] * values, minlength=n)[~is_p], -30.0, 30.0
        for _ in range(60):
            b = (low + high) / 2
            low, high = (b, high) if (shares[~is_p] / (1 + np.exp(-np.clip(x + b, -30, 30)))).sum() < prior else (low, b)
    return w, float(b)


def distinct_texts(texts: DataFrame, words: int = 5) -> DataFrame:
    """One of equal texts, and mostly one of near copies: texts whose smallest shingle agrees under either of two hash
    functions count as one, as the same words in many copies would say nothing about toxicity."""
    def run(batches):
        for pdf in batches:
            sets = [shingle_set(t, words) for t in pdf["text"]]
            both = [[(s * np.uint64(m)).min() if len(s) else hash_of(t) for s, t in zip(sets, pdf["text"])] for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
            yield pd.DataFrame({"text": pdf["text"], **{k: pd.Series(np.array(x, dtype=np.uint64).view(np.int64), index=pdf.index) for k, x in zip(("a", "b"), both)}})

    def hash_of(t):
        return np.uint64(zlib.crc32((t or "").encode("utf-8", "surrogatepass")))

    rows = texts.mapInPandas(run, "text string, a bigint, b bigint")
    rows = rows.groupBy("a").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "b", "text")).alias("x")).select("x.b", "x.text")
    return rows.groupBy("b").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("x.text")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> tuple[dict[int, float], float]:
    """Weights by feature and bias, from rows that aren't held out.  A document is confirmed toxic if any of its labels is 1;
    null labels are no labels.  Of confirmed texts that are copies one counts.  Without a confirmed text the model scores 0."""
    spark = docs.sparkSession
    given = labels.where(F.col(toxic_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(toxic_col) == 1).alias("toxic"))
    given = materialize(given.where(F.col("id").isNotNull() & ~is_held_out(F.col("id"))), "toxicity-labels")
    counts = given.agg(F.count("*").alias("n"), F.count_if("toxic").alias("k")).first()
    if not counts["k"]:
        return {}, float("-inf")
    prior = min((counts["k"] + 1) / (counts["n"] + 2), 0.9)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where(F.col("id").isNotNull() & ~is_held_out(F.col("id")))
    toxic = given.where("toxic").select("id")
    bitmap = Bitmap(toxic.select(F.xxhash64("id").alias("h")), "h", FILTER_BITS)

    @F.pandas_udf("boolean")
    def may_be_toxic(hashes: pd.Series) -> pd.Series:
        return pd.Series(bitmap.may_contain(hashes.to_numpy(dtype=np.int64)))

    confirmed = texts.where(may_be_toxic(F.xxhash64("id"))).join(toxic.hint("merge"), "id").select("text")
    confirmed = materialize(distinct_texts(confirmed), "toxicity-confirmed")
    n_p, n_u = confirmed.count(), texts.count()
    if not n_p:
        return {}, float("-inf")
    some = count_features(confirmed).orderBy(F.col("n").desc(), "f").limit(CANDIDATES).toPandas().sort_values("f")
    candidates, k_p = some["f"].to_numpy(dtype=np.int64), some["n"].to_numpy(dtype=np.float64)
    found = count_features(texts, spark.sparkContext.broadcast(candidates)).toPandas()  # at most CANDIDATES numbers
    k_u = np.zeros(len(candidates))
    k_u[np.searchsorted(candidates, found["f"].to_numpy(dtype=np.int64))] = found["n"]
    kept = candidates[surest_features(k_p, n_p, k_u, n_u)]
    p, u, size = vectors(confirmed, kept), vectors(texts, kept), len(kept) + 1
    w = fit_moments(moments(p, size) / n_p, moments(u, size) / n_u, prior)
    edges = np.linspace(w[-1] + np.minimum(w[:-1], 0).sum() - 1e-6, w[-1] + np.maximum(w[:-1], 0).sum() + 1e-6, MARGIN_BINS + 1)
    h_p, h_u = margins(p, w, edges), margins(u, w, edges)
    some = np.flatnonzero(h_p + h_u)
    a, b = fit_margins(h_p[some], h_u[some], ((edges[1:] + edges[:-1]) / 2)[some], prior)
    return dict(zip(kept.tolist(), (a * w[:-1]).tolist())), a * float(w[-1]) + b


def scores(docs: DataFrame, model: tuple[dict[int, float], float], text_col: str = "text"):
    """Column: probability that a text is toxic.  Null text counts as empty."""
    weights, bias = model

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept = np.array(sorted(weights), dtype=np.int64)
        by_place = np.array([weights[f] for f in kept.tolist()])
        for s in batches:
            place, at = _rows_of(s.tolist(), kept)
            found, at = by_place[place].tolist() if len(kept) else [], at.tolist()
            out = [bias + sum(sorted(found[i:j])) for i, j in zip(at, at[1:])]
            yield pd.Series(np.exp(-np.logaddexp(0.0, -np.array(out, dtype=float))))

    return run(F.col(f"`{text_col}`"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, held_out, score, predicted per row.

    Labels of held-out ids are never read; ids, languages and sources are no inputs of a score.
    Null and empty texts get the score of a text without features; repeated rows are scored
    each, null ids stay (not held out); other columns are not read; no rows give no rows.
    """
    model = train(docs, labels, id_col, text_col, **options)
    key = F.col(f"`{id_col}`")
    return docs.select(key.alias(id_col), is_held_out(key).alias("held_out"), scores(docs, model, text_col).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the texts predicted toxic; same columns, whatever their names.

    Null and empty texts, which hold no features, and null ids stay or go by the score alone; repeated rows go or stay
    together; no rows give no rows.
    """
    model = train(docs, labels, id_col, text_col, **options)
    return docs.where(scores(docs, model, text_col) < THRESHOLD)
