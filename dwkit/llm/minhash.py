"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

Each distinct shingle set has a signature of 48 symbols of 16 bits; a symbol differs with probability
1 - similarity.  The signature distance is the number of differing symbols.  The join finds *every* pair
within ``DISTANCE`` = 23: cut into 12 chunks of 4 symbols, two such signatures have a chunk with
at most one error (12 * 2 = 24 > 23).  So each chunk is indexed under the four keys that leave out one
symbol, which enumerates its allowed errors.  At a similarity of 0.8 a pair exceeds the distance
with a probability of 1e-6, above it more rarely.

A pair that the join finds is confirmed on the full sets, and components follow from confirmed links:

1. Texts with equal sets are one representative (smallest id), whatever their number.
2. *Pivot round.*  In each bucket every member is compared with the bucket's best-connected member;
   the nearest pivot of each representative is confirmed.  This joins large groups of near
   copies with as many comparisons as members.
3. *Rest.*  Buckets that still hold several components are compared across components, in tiles of
   bounded size; members within the distance fall into clusters, and in each cluster, again in
   tiles, the full sets of different components are compared.  A bucket's or cluster's largest component
   passes the tiles of the other members once.  No bucket is cut, and no pairs
   are written: a task passes on a spanning part of what it finds.

Components come from contraction with pointer jumping, written between the rounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from . import shingles as S
from .bitmaps import Bitmap

DISTANCE = 23
TILE = 1024           # signatures of a bucket that are compared with each other in one tile
TEXT_TILE = 256       # texts of a cluster that are compared with each other in one tile
GROUP = 512           # texts that are compared with one copy of a pivot's text
HELD_EDGES = 200_000  # edges that a task holds before it reduces them
FILTER_BITS = 1 << 24  # bits of the id filter (2 MB), whatever the number of ids
SALTS = 16            # keys under which the rows of a group meet its sizes
SLOTS = S.SYMBOLS     # keys of a signature: one for each symbol that is left out


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, t (hash of the text), n (set size), s1, s2 (digest of the set), sig per row."""
    def run(batches):
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                found = S.shingle_set(text, words)
                if not len(found):
                    rows.append((0, 0, 0, None))
                    continue
                digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype=np.int64)
                rows.append((len(found), int(digest[0]), int(digest[1]), S.signature(found).tobytes()))
            out = pd.DataFrame(rows, columns=["n", "s1", "s2", "sig"], index=pdf.index)
            out.insert(0, "t", pdf["t"])
            out.insert(0, "id", pdf["id"])
            yield out

    text = F.col(f"`{text_col}`")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    return narrow.mapInPandas(run, f"id {narrow.schema['id'].dataType.simpleString()}, t bigint, n bigint, s1 bigint, s2 bigint, sig binary")


def _symbols(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), dtype=np.uint16).reshape(len(sigs), S.SYMBOLS)


def _masked_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, SLOTS) keys; the low six bits are the slot, that is the symbol left out."""
    chunks = sig.reshape(len(sig), -1, S.CHUNK).astype(np.uint64)
    out = np.empty((len(sig), chunks.shape[1], S.CHUNK), dtype=np.uint64)
    for left_out in range(S.CHUNK):
        a, b, c = (chunks[:, :, j] for j in range(S.CHUNK) if j != left_out)
        x = (a << np.uint64(32)) | (b << np.uint64(16)) | c
        x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        out[:, :, left_out] = x * np.uint64(0x94D049BB133111EB)
    slots = np.arange(SLOTS, dtype=np.uint64).reshape(-1, S.CHUNK)
    return ((out ^ (slots << np.uint64(57))) << np.uint64(6) | slots).reshape(len(sig), SLOTS).view(np.int64)


def index_keys(sets: DataFrame) -> DataFrame:
    """(key, rep): the multi-index of all representatives."""
    def run(batches):
        for pdf in batches:
            if len(pdf):
                keys = _masked_keys(_symbols(pdf["sig"]))
                yield pd.DataFrame({"key": keys.ravel(), "rep": np.repeat(pdf["rep"].to_numpy(), SLOTS)})

    return sets.select("rep", "sig").mapInPandas(run, f"key bigint, rep {sets.schema['rep'].dataType.simpleString()}")


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their signature distance, where it is at most DISTANCE."""
    one, two = sets.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), sets.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))

    @F.pandas_udf("int")
    def distance(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series((_symbols(x) != _symbols(y)).sum(axis=1).astype(np.int32) if len(x) else [], dtype="int32")

    both = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b")
    return both.select("a", "b", distance("sa", "sb").alias("d")).where(F.col("d") <= DISTANCE)


def _id_filter(ids: DataFrame, column: str):
    """Predicate that all ``ids`` pass and most others don't."""
    bitmap = Bitmap(ids.select(F.xxhash64(column).alias("h")), "h", FILTER_BITS)

    @F.pandas_udf("boolean")
    def passes(hashes: pd.Series) -> pd.Series:
        return pd.Series(bitmap.may_contain(hashes.to_numpy(dtype=np.int64)))

    return lambda c: passes(F.xxhash64(c))


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full shingle sets are linked.

    Texts meet under ``a``; a's text is repeated for every GROUP partners, so that a
    pivot with many partners spreads over many tasks.
    """
    pairs = materialize(pairs.select("a", "b").distinct(), "near-pairs")
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    members = pairs.join(sizes, "a").select(F.col("b").alias("id"), F.col("a").alias("g"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    pivots = sizes.select(F.col("a").alias("id"), F.col("a").alias("g"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = members.withColumn("pivot", F.lit(0)).unionByName(pivots.withColumn("pivot", F.lit(1)))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.where(_id_filter(ids, "id")(F.col("id")))
    rows = wanted.join(texts.hint("merge"), "id")
    rows = rows.repartition("g", "part").sortWithinPartitions("g", "part", F.col("pivot").desc(), "id")

    def run(batches):
        at, base = None, None
        for pdf in batches:
            out = []
            for g, part, pivot, i, text in zip(pdf["g"].tolist(), pdf["part"].tolist(), pdf["pivot"].tolist(), pdf["id"].tolist(), pdf["text"]):
                if (g, part) != at:
                    at, base = (g, part), None
                if pivot:
                    base = S.shingle_set(text, words) if base is None else base
                elif S.linked(base, S.shingle_set(text, words), percent):
                    out.append((g, i))
            yield pd.DataFrame(out, columns=["a", "b"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("g", "part", "pivot", "id", "text").mapInPandas(run, f"a {kind}, b {kind}").distinct()


def components(links: DataFrame) -> DataFrame:
    """(rep, c): the smallest id reachable from each id in ``links`` (a, b).

    Each round every node takes its smallest neighbour (or itself), follows that twice, and the links are
    rewritten between the new classes; rounds end when no link is left.
    """
    edges = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "near-links")
    comp = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
        for _ in range(2):
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p").select("a", F.col("pp").alias("p"))
        parent = materialize(parent, "near-parents")
        if comp is None:
            comp = parent.select(F.col("a").alias("rep"), F.col("p").alias("c"))
        else:
            up = parent.select(F.col("a").alias("c"), "p")
            comp = comp.join(up, "c", "left").select("rep", F.coalesce("p", "c").alias("c"))
        comp = materialize(comp, "near-components")
        low, high = parent.select("a", F.col("p").alias("x")), parent.select(F.col("a").alias("b"), F.col("p").alias("y"))
        moved = edges.join(low, "a").join(high, "b").where("x != y")
        edges = materialize(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-links")
    kind = links.schema["a"].dataType.simpleString()
    return comp if comp is not None else edges.select(F.col("a").cast(kind).alias("rep"), F.col("b").cast(kind).alias("c"))


def _classes(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest index of each node's class in the graph with edges p - q."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, p, label[q])
        np.minimum.at(new, q, label[p])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edges with the same components: each node with the smallest of its component."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = _classes(len(names), at[:len(a)], at[len(a):])
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[label[moved]], names[moved]


def _by_group(keys: list[str], fn):
    """Batches sorted by ``keys`` -> edges (a, b) that ``fn`` finds in frames of whole groups.

    A task passes on a spanning part of its edges only; HELD_EDGES bounds what it keeps until then.
    """
    def run(batches):
        a, b = [], []
        for found in groups(batches):
            if len(found):
                a.append(found["a"].to_numpy())
                b.append(found["b"].to_numpy())
            if sum(map(len, a)) > HELD_EDGES:
                x, y = _spanning(np.concatenate(a), np.concatenate(b))
                a, b = ([x], [y]) if len(x) <= HELD_EDGES // 2 else ([], [])
                if not a:
                    yield pd.DataFrame({"a": x, "b": y})
        if a:
            x, y = _spanning(np.concatenate(a), np.concatenate(b))
            yield pd.DataFrame({"a": x, "b": y})

    def groups(batches):
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            open_ = np.ones(len(pdf), dtype=bool)
            for k in keys:
                open_ &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
            held = pdf[open_].reset_index(drop=True)
            if not open_.all():
                yield fn(pdf[~open_].reset_index(drop=True))
        if held is not None:
            yield fn(held)

    return run


def _tiled(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows (key, rep, c) of groups with several components, dealt to pairs (t1, t2) of tiles of about ``size`` rows.

    Any two rows of a group that are in different components meet in one pair of tiles.  The largest component of a group
    has tiles of its own, which meet only the tiles of the other members: a group of n rows, m of them
    outside its largest component, gives n * ceil(m / size) + m * ceil((n - m) / size) rows at most.
    Rows meet their group's sizes under SALTS keys, so a hot group spreads before it is dealt.
    """
    by_part = rows.groupBy(key, "c").agg(F.count("*").alias("n"))
    sizes = by_part.groupBy(key).agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "c")).alias("top")).where("parts > 1")
    sizes = sizes.select(key, F.col("top.c").alias("top"), F.ceil((F.col("n") - F.col("top.n")) / size).cast("int").alias("others"),
                         F.ceil(F.col("top.n") / size).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit("salt")), F.lit(SALTS)).cast("int")).join(sizes.hint("merge"), [key, "salt"])
    inside = F.col("c") == F.col("top")
    dealt = dealt.withColumn("t", F.when(inside, F.col("others") + F.pmod(F.xxhash64("rep"), F.col("own"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("others"))).cast("int"))
    dealt = dealt.withColumn("u", F.explode(F.sequence(F.lit(0), F.when(inside, F.col("others")).otherwise(F.col("others") + F.col("own")) - 1)))
    return dealt.withColumns({"t1": F.least("t", "u"), "t2": F.greatest("t", "u")}).drop("u", "salt", "top", "others", "own")


def _clusters(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): edges whose components contain every two representatives of different components that
    share a key and are within DISTANCE.  At most one edge per member and key leaves a task."""
    dealt = _tiled(rows, "key", TILE).join(sets.select("rep", "sig").hint("merge"), "rep")
    dealt = dealt.select("key", "t1", "t2", "t", "rep", "c", "sig").repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2", "rep")
    kind = sets.schema["rep"].dataType.simpleString()

    def edges(pdf):
        sig, rep, c, t = _symbols(pdf["sig"]), pdf["rep"].to_numpy(), pdf["c"].to_numpy(), pdf["t"].to_numpy()
        spread = (pdf["t1"] != pdf["t2"]).to_numpy()
        group = pdf.groupby(["key", "t1", "t2"], sort=False).ngroup().to_numpy()
        ps, qs, step = [], [], 1
        while step < len(pdf):
            i = np.flatnonzero(group[:-step] == group[step:])
            if not len(i):
                break
            i = i[(c[i] != c[i + step]) & (~spread[i] | (t[i] != t[i + step]))]
            for k in range(0, len(i), 1 << 15):
                p = i[k:k + (1 << 15)]
                p = p[(sig[p] != sig[p + step]).sum(axis=1) <= DISTANCE]
                ps.append(p)
                qs.append(p + step)
            step += 1
        none = np.empty(0, dtype=np.int64)
        label = _classes(len(pdf), np.concatenate(ps or [none]), np.concatenate(qs or [none]))
        moved = np.flatnonzero(label != np.arange(len(pdf)))
        return pd.DataFrame({"a": rep[label[moved]], "b": rep[moved]})

    return dealt.mapInPandas(_by_group(["key", "t1", "t2"], edges), f"a {kind}, b {kind}").distinct()


def _confirm_clusters(clusters: DataFrame, comp: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """Links (a, b) between different components inside each cluster (rep, c), on full sets.

    Texts meet tile by tile; a set is compared with all others of its tiles in one array operation.
    Only a spanning part of a task's links leaves it.
    """
    rows = clusters.withColumnRenamed("c", "cluster").join(comp, "rep", "left").select("cluster", "rep", F.coalesce("c", "rep").alias("c"))
    rows = materialize(rows, "near-clusters")
    dealt = _tiled(rows, "cluster", TEXT_TILE)
    texts = docs.select(F.col(f"`{id_col}`").alias("rep"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.where(_id_filter(rows.select("rep"), "rep")(F.col("rep")))
    dealt = dealt.join(texts.hint("merge"), "rep").select("cluster", "t1", "t2", "t", "rep", "c", "text")
    dealt = dealt.repartition("cluster", "t1", "t2").sortWithinPartitions("cluster", "t1", "t2", "rep")
    kind = rows.schema["rep"].dataType.simpleString()

    def links(pdf):
        out = []
        for _, g in pdf.groupby(["cluster", "t1", "t2"], sort=False):
            rep, c, t = g["rep"].to_numpy(), g["c"].to_numpy(), g["t"].to_numpy()
            spread = g["t1"].iloc[0] != g["t2"].iloc[0]
            sets = [S.shingle_set(x, words) for x in g["text"]]
            size = np.fromiter(map(len, sets), dtype=np.int64)
            names, codes = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.cumsum(size) - size
            ps, qs = [], []
            for i in range(len(g) - 1):
                if not size[i]:
                    continue
                other = np.flatnonzero((c[i + 1:] != c[i]) & (~np.bool_(spread) | (t[i + 1:] != t[i])) & (size[i + 1:] > 0)) + i + 1
                if not len(other):
                    continue
                mark = np.zeros(len(names) + 1, dtype=np.int64)
                mark[codes[starts[i]:starts[i] + size[i]]] = 1
                common = np.concatenate([[0], np.cumsum(mark[codes])])
                both = common[starts[other] + size[other]] - common[starts[other]]
                j = other[100 * both >= percent * (size[i] + size[other] - both)]
                ps.append(np.full(len(j), i))
                qs.append(j)
            none = np.empty(0, dtype=np.int64)
            label = _classes(len(g), np.concatenate(ps or [none]), np.concatenate(qs or [none]))
            moved = np.flatnonzero(label != np.arange(len(g)))
            out.append(pd.DataFrame({"a": rep[label[moved]], "b": rep[moved]}))
        return pd.concat(out, ignore_index=True)

    return dealt.mapInPandas(_by_group(["cluster", "t1", "t2"], links), f"a {kind}, b {kind}").distinct()


def _marked(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """id, t, n, component, kept per row."""
    rows = materialize(signatures(docs, id_col, text_col, words), "near-signatures")
    real = rows.where("n > 0")
    sets = real.groupBy("s1", "s2").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"))
    sets = materialize(sets, "near-sets")
    known = sets.where(F.col("rep").isNotNull())
    # 1. buckets with more than one representative
    keys = index_keys(known)
    several = keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("size")).where("lo != hi")
    members = materialize(keys.join(several.select("key", "size").hint("merge"), "key"), "near-buckets")
    # 2. each bucket's best-connected member is its pivot
    degree = members.groupBy("rep").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "rep")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("degree", F.col("rep").alias("b"))).alias("top")).select("key", "top.b")
    stars = members.join(pivots.hint("merge"), "key").where("rep != b").select(F.col("b").alias("a"), F.col("rep").alias("b")).distinct()
    nearest = _distances(stars, known).groupBy("b").agg(F.min(F.struct("d", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    by_pivot = materialize(confirm(nearest, docs, id_col, text_col, words, percent), "near-confirmed")
    comp = components(by_pivot)
    # 3. what is left between components
    placed = materialize(members.select("key", "rep").join(comp, "rep", "left").select("key", "rep", F.coalesce("c", "rep").alias("c")), "near-members")
    clusters = components(_clusters(placed, known))
    rest = materialize(_confirm_clusters(clusters, comp, docs, id_col, text_col, words, percent), "near-confirmed")
    if not rest.isEmpty():
        comp = components(by_pivot.unionByName(rest))
    of_set = sets.select("s1", "s2", "rep").join(comp, "rep", "left").select("s1", "s2", F.coalesce("c", "rep").alias("c"))
    marked = rows.join(of_set, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("id"))
    return marked.select("id", "t", "n", component.alias("component"), F.col("id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id, kept per row.

    Two texts are linked when 100 * common >= percent * all of their distinct word shingles.  component_id is
    the smallest id reachable over links, kept says that it is the row's own.  Texts without words
    (null, empty) have no shingles and link with nothing.  Rows that repeat id and text are all
    marked alike; texts that come with null ids only are not linked and keep a null component.  Other
    columns are not read; no rows give no rows.
    """
    return _marked(docs, id_col, text_col, words, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, same columns; of rows that repeat id and text
    one stays."""
    kept = _marked(docs, id_col, text_col, words, percent).where("kept").select("id", "t").distinct()
    names = docs.columns
    rows = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    i, t = F.col(f"_c{names.index(id_col)}"), F.xxhash64(F.col(f"_c{names.index(text_col)}"))
    rows = rows.withColumn("_t", t).join(kept.hint("merge"), i.eqNullSafe(F.col("id")) & (F.col("_t") == F.col("t")), "left_semi")
    once = Window.partitionBy(i, "_t").orderBy("_t")
    rows = rows.withColumn("_copy", F.row_number().over(once)).where("_copy = 1").drop("_copy", "_t")
    return rows.toDF(*names)
