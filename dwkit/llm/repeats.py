"""Removal of repeated passages by longest previous factors.

A byte goes when a string of ``LENGTH`` = 100 bytes that covers it also starts earlier, that is
when the longest previous factor at some start is that long.  One suffix array over the corpus
would not fit a task, so the suffixes are first split into independent groups:

1. Every window of 100 bytes is assigned to its *anchor*, the place of the smallest hash among
   its 32-byte strings (leftmost on ties).  Equal windows have equal anchors at the same offset.
   The neighbouring windows that share an anchor form a *span*, about one in 35 bytes.
2. Spans whose anchor string occurs once in the corpus have no equal windows; a count and
   a bitmap drop them.
3. Spans with equal content are a class.  All its members but the first are covered whole.
4. What can differ are first members of different classes with one anchor string.  Their
   windows are sorted (suffix order, compared to 100 bytes) together with their positions;
   within a run of windows that agree in 100 bytes, a window has a previous factor of that length
   if and only if a smaller position precedes it (previous smaller) or follows it (next smaller).

Groups in step 4 are refined by the 34 bytes beside the anchor.  Where a group is still large, bounded
slices of it are solved where they lie; the windows that are first in their slice are grouped by their
bytes: an aggregate finds the first place of each, a join marks the others, and no task holds an unbounded group.
The first occurrence always stays: positions are compared by (id, start).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import materialize
from .bitmaps import Bitmap

LENGTH, GRAM = 100, 32
SIDE = (LENGTH - GRAM) // 2
SEGMENT = 1 << 16          # bytes that are hashed at once: its arrays stay in a core's cache
SLICE = 500                # rows of an Arrow batch that are Python objects at once
BITS = 1 << 27             # bits of the bitmaps (16 MB)
SOLVE_ROWS = 2000          # spans whose windows are sorted at once
CROWD = 2000               # spans of a group above which it is solved in slices
LAST = (1 << 63) - 1       # order of null ids
_RNG = np.random.default_rng(29)
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= _B
    return x


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring strings from theirs."""
    x = a * _A
    x += b
    return _mix(x)


class Spans:
    """Spans of the valid windows in a buffer of text segments.

    ``seg``, ``first``, ``last``: segment and first and last window start (in the segment);
    ``at``: anchor place; ``g``: hash of the anchor string; ``h``: hash of the span's content.
    """

    def __init__(self, segments: list[bytes]):
        sizes = np.fromiter(map(len, segments), dtype=np.int64)
        self.data = data = np.frombuffer(b"".join(segments), dtype=np.uint8)
        starts = np.cumsum(sizes) - sizes
        n = len(data) - LENGTH + 1
        h = _TABLE[data]
        kept = {}
        size = 1
        while size < 64:
            h = _joined(h[:-size], h[size:])
            size *= 2
            kept[size] = h
        window = _joined(_joined(kept[64][:n], kept[32][64:64 + n]), kept[4][96:96 + n])
        grams = kept[GRAM]
        low = np.uint64((1 << 24) - 1)
        m = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while size < 64:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        reach = LENGTH - GRAM + 1 - 64
        m = np.minimum(m[:-reach], m[reach:])
        place = (m & low).astype(np.int64)
        owner = np.repeat(np.arange(len(segments)), sizes)[:n]
        valid = (starts + sizes)[owner] - np.arange(n) >= LENGTH
        new = np.ones(n, dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(new & valid)
        ends = np.flatnonzero(np.append(new[1:] | ~valid[1:], True) & valid)
        self.begin, self.end = begin, ends
        self.seg, self.base = owner[begin], starts[owner[begin]]
        self.first, self.last = begin - self.base, ends - self.base
        self.place = place[begin]
        self.g = grams[self.place]
        shape = ((ends - begin) << 8 | (self.place - begin)).astype(np.uint64)
        self.h = _joined(_joined(window[begin], window[ends]), shape * _A)
        self.window = window


def _segments(ids, hashes, texts):
    """Groups of (id, text hash, offset, bytes) of about SEGMENT bytes; long texts are cut with overlap."""
    group, size = [], 0
    for i, t, text in zip(ids, hashes, texts):
        data = text.encode("utf-8", "surrogatepass")
        for at in range(0, max(len(data) - LENGTH + 1, 0), SEGMENT):
            part = data[at:at + SEGMENT + LENGTH - 1]
            if group and size + len(part) > SEGMENT:
                yield group
                group, size = [], 0
            group.append((i, t, at, part))
            size += len(part)
    if group:
        yield group


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _spans(pdf):
    for group in _segments(pdf["o"].tolist(), pdf["t"].tolist(), pdf["text"]):
        found = Spans([x[3] for x in group])
        o, t = np.array([x[0] for x in group], dtype=np.int64), np.array([x[1] for x in group], dtype=np.int64)
        offset = np.array([x[2] for x in group], dtype=np.int64)
        yield found, o[found.seg], t[found.seg], offset[found.seg]


def _identity(g, h, o, first) -> np.ndarray:
    """Hash of one span occurrence (for the bitmap)."""
    return _joined(_joined(g ^ h, o.view(np.uint64)), first.astype(np.uint64) * _A).view(np.int64)


def _read(texts: DataFrame, fn, schema: str) -> DataFrame:
    """Rows that ``fn`` (columns as arrays) finds in the spans of all texts."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for part in _slices(batches):
            found = [fn(*x) for x in _spans(part.to_pandas())]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c] for f in found]), t) for c, t in zip(kind.names, kind.types)], schema=kind)

    return texts.mapInArrow(run, schema)


def _repeated_spans(texts: DataFrame) -> DataFrame:
    """(g, h, o, t, first, last) of the spans whose anchor string occurs more than once."""
    grams = _read(texts, lambda s, o, t, at: {"g": s.g.view(np.int64)}, "g bigint")
    several = grams.groupBy("g").agg(F.count("*").alias("n")).where("n > 1")
    bitmap = Bitmap(several, "g", BITS)

    def some(s, o, t, at):
        keep = bitmap.may_contain(s.g)
        return {"g": s.g[keep].view(np.int64), "h": s.h[keep].view(np.int64), "o": o[keep], "t": t[keep],
                "first": (at + s.first)[keep], "last": (at + s.last)[keep]}

    return materialize(_read(texts, some, "g bigint, h bigint, o bigint, t bigint, first bigint, last bigint"), "repeat-spans")


def _contested_windows(texts: DataFrame, contested: DataFrame) -> DataFrame:
    """(key, sub, o, t, first, count, bytes): windows of the first members of classes that share an anchor.

    ``first`` is the start of the first of ``count`` windows that lie in ``bytes``.
    """
    def run_identity(batches):
        for pdf in batches:
            yield pd.DataFrame({"i": _identity(*(pdf[c].to_numpy().view(np.uint64) for c in ("g", "h")), pdf["o"].to_numpy(), pdf["first"].to_numpy())})

    bitmap = Bitmap(contested.select("g", "h", "o", "first").mapInPandas(run_identity, "i bigint"), "i", BITS)

    def rows(s, o, t, at):
        chosen = np.flatnonzero(bitmap.may_contain(_identity(s.g, s.h, o, at + s.first)))
        out, data = [], s.data
        for k in chosen.tolist():
            a, b, q, g = int(s.begin[k]), int(s.end[k]), int(s.place[k]), int(s.g[k])
            # windows that reach SIDE bytes to the left of the anchor, then the others (they reach right)
            for lo, hi, side in ((a, min(b, q - SIDE), data[q - SIDE:q] if q - SIDE >= a else None),
                                 (max(a, q - SIDE + 1), b, data[q + GRAM:q + GRAM + SIDE])):
                if lo <= hi:
                    mark = hashlib.blake2b(side.tobytes(), digest_size=8, key=g.to_bytes(8, "little"), person=b"L" if hi <= q - SIDE else b"R").digest()
                    out.append((int.from_bytes(mark, "little", signed=True), int(o[k]), int(t[k]), int(at[k]) + lo - int(s.base[k]),
                                hi - lo + 1, data[lo:hi + LENGTH].tobytes()))
        parts = list(zip(*out)) or [()] * 6
        kinds = {"key": np.int64, "o": np.int64, "t": np.int64, "first": np.int64, "count": np.int32, "bytes": object}
        return {c: np.array(part, dtype=kind) for (c, kind), part in zip(kinds.items(), parts)}

    # only texts that hold such a span are hashed again
    holders = Bitmap(contested.select(F.xxhash64("o", "t").alias("i")), "i", BITS >> 3)

    @F.pandas_udf("boolean")
    def holds(i: pd.Series) -> pd.Series:
        return pd.Series(holders.may_contain(i.to_numpy(dtype=np.int64)))

    return materialize(_read(texts.where(holds(F.xxhash64("o", "t"))), rows, "key bigint, o bigint, t bigint, first bigint, count int, bytes binary"), "repeat-windows")


def earlier_windows(windows: np.ndarray, position: np.ndarray) -> np.ndarray:
    """For windows (an array of equal-length byte strings) at ``position`` (their rank in reading
    order): whether the longest previous factor covers the window.

    Sorting gives the suffix order.  In a run of equal windows the running minimum of the positions
    before a window tells whether a previous smaller position exists, the one from behind a next smaller.
    """
    order = np.argsort(windows, kind="stable")
    w, pos = windows[order], position[order]
    run = np.concatenate([[0], np.cumsum(w[1:] != w[:-1])]) if len(w) else np.empty(0, dtype=np.int64)
    top = int(position.max()) + 1 if len(w) else 1
    # the offset by run makes one accumulate restart at every run
    before = np.minimum.accumulate(pos - run * top) + run * top
    behind = (np.minimum.accumulate((pos + run * top)[::-1])[::-1]) - run * top
    out = np.zeros(len(w), dtype=bool)
    out[order] = (before < pos) | (behind < pos)
    return out


def _solve(pdf: pd.DataFrame, firsts: bool = False) -> pd.DataFrame:
    """(o, t, first, last) of the windows that have an earlier equal under their key in ``pdf``; with
    ``firsts`` also the others one by one, with key and window (else null)."""
    pdf = pdf.drop_duplicates(["key", "o", "t", "first"], ignore_index=True)  # rows that repeat id and text
    count = pdf["count"].to_numpy()
    data = [np.frombuffer(b, dtype=np.uint8) for b in pdf["bytes"]]
    strings = np.concatenate([np.lib.stride_tricks.sliding_window_view(d, LENGTH) for d in data]) + np.uint8(1)  # no zero bytes
    row = np.repeat(np.arange(len(pdf)), count)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = pdf["first"].to_numpy()[row] + inside
    group = np.unique(pdf["key"].to_numpy(), return_inverse=True)[1][row]
    rank = np.lexsort((start, pdf["t"].to_numpy()[row], pdf["o"].to_numpy()[row]))
    position = np.empty(len(row), dtype=np.int64)
    position[rank] = np.arange(len(row))
    mark = (group.astype(">u8") + np.uint64(0x0101010101010101)).astype(">u8").view(np.uint8).reshape(-1, 8)
    whole = np.ascontiguousarray(np.concatenate([mark, strings], axis=1)).view(f"S{LENGTH + 8}").ravel()
    hit = earlier_windows(whole, position)
    cut = np.ones(len(row), dtype=bool)
    cut[1:] = (row[1:] != row[:-1]) | (hit[1:] != hit[:-1])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(row)) - 1
    use = hit[begin]
    i, j = begin[use], end[use]
    o, t = pdf["o"].to_numpy()[row], pdf["t"].to_numpy()[row]
    out = pd.DataFrame({"o": o[i], "t": t[i], "first": start[i], "last": start[j]})
    if not firsts:
        return out
    new = np.flatnonzero(~hit)
    found = {"o": o[new], "t": t[new], "first": start[new], "last": start[new], "key": pdf["key"].to_numpy()[row[new]], "window": [w.tobytes() for w in strings[new]]}
    return pd.concat([out.assign(key=0, window=None), pd.DataFrame(found)], ignore_index=True)


def _crowded(windows: DataFrame) -> DataFrame:
    """(o, t, first, last) of the windows that have an earlier equal under their key, for groups of any size."""
    def local(batches):
        for pdf in batches:
            for at in range(0, len(pdf), SOLVE_ROWS):
                yield _solve(pdf.iloc[at:at + SOLVE_ROWS], firsts=True)

    solved = materialize(windows.mapInPandas(local, "o bigint, t bigint, first bigint, last bigint, key bigint, window binary"), "repeat-crowded")
    firsts = solved.where("window IS NOT NULL")
    place = F.struct("o", "t", "first")
    heads = firsts.groupBy("key", "window").agg(F.min(place).alias("one"), F.count("*").alias("n")).where("n > 1")
    # written first, so that the join has an exchange on both sides and a hot window's rows can be split
    heads = materialize(heads.select("key", "window", "one"), "repeat-heads")
    later = firsts.join(heads.hint("merge"), ["key", "window"]).where(place != F.col("one"))
    return solved.where("window IS NULL").select("o", "t", "first", "last").unionByName(later.select("o", "t", "first", "last"))


def _covered(windows: DataFrame) -> DataFrame:
    """(o, t, first, last) of the contested windows that have an earlier equal."""
    sizes = materialize(windows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeat-sizes")
    crowds = Bitmap(sizes.where(F.col("n") > CROWD), "key", BITS >> 3)

    @F.pandas_udf("boolean")
    def crowd(key: pd.Series) -> pd.Series:
        return pd.Series(crowds.may_contain(key.to_numpy(dtype=np.int64)))

    # a calm group that passes the bitmap is solved twice, to the same windows
    crowded = _crowded(windows.where(crowd("key")))
    calm = windows.join(sizes.where(F.col("n") <= CROWD).hint("merge"), "key").select("key", "o", "t", "first", "count", "bytes")
    dealt = calm.repartition("key").sortWithinPartitions("key", "o", "t", "first")

    def run(batches):
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            starts = np.flatnonzero(np.append(True, pdf["key"].to_numpy()[1:] != pdf["key"].to_numpy()[:-1]))
            # whole groups at a time, about SOLVE_ROWS rows (a group has CROWD rows at most)
            at = 0
            for end in starts[1:].tolist():
                if end - at >= SOLVE_ROWS or end == starts[-1]:
                    yield _solve(pdf.iloc[at:end].reset_index(drop=True))
                    at = end
            held = pdf.iloc[at:].reset_index(drop=True)
        if held is not None:
            yield _solve(held)

    return dealt.mapInPandas(run, "o bigint, t bigint, first bigint, last bigint").unionByName(crowded)


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """(o, t, first, last): ranges of window starts that have an earlier equal window."""
    spans = _repeated_spans(texts)
    place = F.struct("o", "t", "first")
    classes = materialize(spans.groupBy("g", "h").agg(F.min(place).alias("one"), F.count("*").alias("n")), "repeat-classes")
    firsts = classes.select("g", "h", "n", "one.*")
    later = spans.join(classes.where("n > 1").select("g", "h", "one").hint("merge"), ["g", "h"]).where(place != F.col("one"))
    several = firsts.groupBy("g").agg(F.count("*").alias("classes")).where("classes > 1")
    contested = firsts.join(several.hint("merge"), "g")
    return later.select("o", "t", "first", "last").unionByName(_covered(_contested_windows(texts, contested)))


def _apply(batches, as_text: bool, kind: pa.Schema):
    """Remove the ranges of each row; digests of what stays, or the text itself."""
    for part in _slices(batches):
        out = []
        for text, firsts, lasts in zip(*(part.column(c) for c in ("text", "firsts", "lasts"))):
            data = text.as_py().encode("utf-8", "surrogatepass")
            gone, spans, at, kept = 0, 0, 0, []
            if firsts.is_valid and len(firsts):
                a, b = firsts.values.to_numpy(), lasts.values.to_numpy() + LENGTH
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.append(True, a[1:] > b[:-1])
                for lo, hi in zip(a[new].tolist(), b[np.append(new[1:], True)].tolist()):
                    kept.append(data[at:lo])
                    gone, spans, at = gone + hi - lo, spans + 1, hi
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((gone, spans, rest.decode("utf-8", "ignore") if as_text else hashlib.sha256(rest).hexdigest()))
        found = [pa.array(x, t) for x, t in zip(zip(*out), kind.types[2:])]
        yield pa.RecordBatch.from_arrays([part.column("id"), part.column("n_bytes"), *found], schema=kind)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 per row; with ``as_text`` kept_text instead (bytes
    that no longer form characters after a cut are left out of it).

    Ids are whole numbers; null ids come after all others.  Rows that repeat id and text are one
    document, marked alike; different texts under one id are documents ordered by text hash.  Null text
    counts as empty, texts under 100 bytes keep everything, other columns are not read, no rows
    give no rows.
    """
    base = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    texts = base.select(F.coalesce("id", F.lit(LAST)).alias("o"), F.xxhash64("text").alias("t"), "text")
    # a document's ranges, at most one for each of its bytes
    ranges = repeated_ranges(texts).groupBy("o", "t").agg(F.collect_list(F.struct("first", "last")).alias("r"))
    ranges = materialize(ranges.select("o", "t", F.col("r.first").alias("firsts"), F.col("r.last").alias("lasts")), "repeat-ranges")
    bitmap = Bitmap(ranges.select(F.xxhash64("o", "t").alias("i")), "i", BITS >> 3)

    @F.pandas_udf("boolean")
    def touched(i: pd.Series) -> pd.Series:
        return pd.Series(bitmap.may_contain(i.to_numpy(dtype=np.int64)))

    full = base.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.coalesce("id", F.lit(LAST)).alias("o"), F.xxhash64("text").alias("t"), "text")
    full = full.withColumn("touched", touched(F.xxhash64("o", "t")))
    calm = full.where(~F.col("touched")).select("id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                                               (F.col("text") if as_text else F.sha2("text", 256)).alias("kept"))
    cut = full.where("touched").join(ranges.hint("merge"), ["o", "t"], "left").select("id", "n_bytes", "text", "firsts", "lasts")
    shape = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept string"
    kind = to_arrow_schema(StructType.fromDDL(shape))
    cut = cut.mapInArrow(lambda b: _apply(b, as_text, kind), shape)
    return calm.unionByName(cut).withColumnsRenamed({"id": id_col, "kept": "kept_text" if as_text else "kept_sha256"})
