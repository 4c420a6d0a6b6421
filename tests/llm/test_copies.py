"""Exact copies, near copies and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dwkit.llm import exact_dedup, minhash, repeats


def _norm(t):
    return re.sub(r"[\x20\x09-\x0d]+", " ", t or "")


def _exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[_norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(_norm(t).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"capacity": 2, "hash_bits": 6, "digest_chars": 1}])
def test_exact_dedup(spark, awkward, nothing, options):
    """The second case forces bucket splits, chained collisions and unequal bytes under one key."""
    got = exact_dedup.exact_dedup(awkward, **options).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _exact([(r.doc_id, r.text) for r in awkward.collect()])))
    if not options:
        assert exact_dedup.exact_dedup(nothing).count() == 0


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(3000).select(F.shiftrightunsigned(F.xxhash64("id"), 32).alias("h")).unionByName(
        spark.range(50).select(F.col("id").alias("h"))).distinct()
    n = keys.count()
    directory, width = exact_dedup.grow_directory(keys, n, hash_bits=32, capacity=100)
    rows = keys.withColumn("leaf", F.shiftrightunsigned("h", 32 - width)).join(directory, "leaf")
    loads = {(r.bucket, r.depth): r["count"] for r in rows.groupBy("bucket", "depth").count().collect()}
    assert sum(loads.values()) == n and max(loads.values()) <= 100 and len({d for _, d in loads}) >= 1


def test_drop_exact_copies(spark, awkward):
    left = exact_dedup.drop_exact_copies(awkward)
    assert left.columns == awkward.columns
    ids = sorted((r.doc_id for r in left.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 3, 5, 6, 8, 9, 10, 11, 12, None]


def _components(rows, words, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets.append({b" ".join(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                label[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        if rows[k][0] is not None:
            groups[find(k)] = min(groups.get(find(k), rows[k][0]), rows[k][0])
    return [(i, len(s), groups.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = minhash.near_duplicates(docs, words=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(_components(rows, 4, 80))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_chains_and_cases(spark, awkward, nothing, monkeypatch):
    """A chain of gradual edits (no hub), a large group around a text, tiles of four rows."""
    monkeypatch.setattr(minhash, "TILE", 4)
    monkeypatch.setattr(minhash, "TEXT_TILE", 4)
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    rows, text = [], list(words)
    for i in range(12):
        rows.append((100 + i, " ".join(text)))
        text[rnd.randrange(120)] = f"new{i}"
        text[rnd.randrange(120)] = f"more{i}"
    for i in range(14):
        t = [f"v{k}" for k in range(100)]
        t[rnd.randrange(100)] = f"edit{i}"
        rows.append((200 + i, " ".join(t)))
    rows += [(r.doc_id, r.text) for r in awkward.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = minhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted((str(i), n, str(c)) for i, n, c in _components(rows, 5, 80))
    assert minhash.near_duplicates(nothing).count() == 0
    left = minhash.drop_near_copies(awkward)
    assert left.columns == awkward.columns
    assert sorted((r.doc_id for r in left.collect()), key=lambda x: (x is None, x)) == [1, 3, 4, 5, 6, 9, 10, 11, 12, None]


def test_every_pair_within_the_distance_shares_a_key():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 65536, (400, 48)).astype(np.uint16)
    other = base.copy()
    for i in range(400):
        at = rnd.choice(48, minhash.DISTANCE, replace=False)
        other[i, at] ^= np.uint16(1)
    a, b = minhash._masked_keys(base), minhash._masked_keys(other)
    assert all(np.intersect1d(x, y).size for x, y in zip(a, b))


def _repeats(rows):
    seen, out = set(), []
    done = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (t or "").encode()
        if (i, t) not in done:
            gone = np.zeros(len(data) + 1, dtype=np.int64)
            for p in range(len(data) - 99):
                w = data[p:p + 100]
                if w in seen:
                    gone[p] += 1
                    gone[p + 100] -= 1
                seen.add(w)
            m = np.cumsum(gone)[:len(data)] > 0
            spans = int((m & ~np.concatenate([[False], m[:-1]])).sum()) if len(data) else 0
            rest = np.frombuffer(data, dtype=np.uint8)[~m].tobytes()
            done[i, t] = (len(data), int(m.sum()), spans, hashlib.sha256(rest).hexdigest())
        out.append((i, *done[i, t]))
    return out


def test_repeats(spark, awkward, nothing, monkeypatch):
    rnd = random.Random(6)
    passages = ["".join(rnd.choice("abcdefgh é") for _ in range(n)) for n in (90, 99, 100, 101, 150, 400)]
    rows = []
    for i in range(60):
        body = "".join(rnd.choice("ijklmnop ") for _ in range(rnd.randint(0, 250)))
        at = rnd.randint(0, len(body))
        rows.append((1000 + i, body[:at] + rnd.choice(passages) + body[at:]))
    rows += [(2000, "".join(rnd.choice("qrst") for _ in range(70000)) + passages[5] + passages[5]), (2001, passages[4] * 30)]
    rows += [(r.doc_id, r.text) for r in awkward.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = sorted(map(str, _repeats(rows)))
    assert sorted(map(str, map(tuple, repeats.remove_repeats(docs).collect()))) == want
    monkeypatch.setattr(repeats, "CROWD", 1)  # every group is dealt window by window
    assert sorted(map(str, map(tuple, repeats.remove_repeats(docs).collect()))) == want
    monkeypatch.undo()
    assert repeats.remove_repeats(nothing).count() == 0
    kept = {r.doc_id: r.kept_text for r in repeats.remove_repeats(docs, as_text=True).collect()}
    assert kept[6] == "one" and kept[2] == ""


def test_equal_windows_of_a_crowd_do_not_meet_in_a_python_task(spark, monkeypatch):
    """Many contested spans share their windows at one end: they are aggregated, and only calm groups reach the solver."""
    rnd = random.Random(12)
    monkeypatch.setattr(repeats, "SOLVE_ROWS", 16)
    shared = "".join(rnd.choice("abcdefgh") for _ in range(160))
    rows = [(i, "".join(rnd.choice("ijklmnop") for _ in range(60)) + shared + "".join(rnd.choice("qrstuvwx") for _ in range(60))) for i in range(300)]
    rows += [(1000, rows[0][1][:170]), rows[0], rows[7]]
    solved, whole = [], repeats._covered

    def watch(windows):
        out = whole(windows)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        keys = windows.groupBy("key").count().where("count > 1").collect()
        solved.append((plan, max(r["count"] for r in keys)))
        return out

    monkeypatch.setattr(repeats, "CROWD", 20)
    monkeypatch.setattr(repeats, "_covered", watch)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _repeats(rows)))
    (plan, largest), = solved
    assert largest > 100  # the crowd is there
    solver = plan[plan.index("MapInPandas"):]
    assert plan.count("MapInPandas") == 1 and "(n#" in solver and "<= 20" in solver


def test_earlier_windows():
    w = np.array([b"b", b"a", b"b", b"a", b"c", b"b"], dtype="S1")
    pos = np.array([5, 1, 2, 4, 3, 0])
    assert repeats.earlier_windows(w, pos).tolist() == [True, False, True, True, False, False]
