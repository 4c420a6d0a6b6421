"""Importance resampling, tokenizer alignment and quality votes against brute force and the libraries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dwkit.llm import alignment, importance, quality

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = " \n\t\r\x0b'sltvmrd\x1c\x85\xa0　aàé1²½.,!<|endoftext|>𝔸🙂中ア\x00_-(){}▁"


# ------------------------------------------------------------------ importance resampling

def _buckets(text):
    words = WORD.findall((text or "").translate(LOW))
    return [zlib.crc32(x.encode()) % 10000 for x in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def _brute_resample(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(_buckets(text))
    for text in target:
        t.update(_buckets(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for key, text in docs:
        found = _buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if (r[1] + 1) // 2 >= 20), key=lambda r: (-r[3], float("inf") if r[0] is None else r[0]))
    return rows, able[:25 * len(able) // 100]


def test_features_equal_direct_hashes():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(ODD + "ABCxyz09 ") for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    texts += [None, "", "one", "a" * 300 + " b " + "c" * 700 + " é" * 3, "x " * 50000]
    buckets, text = importance.Features().block(texts)
    for i, t in enumerate(texts):
        assert Counter(buckets[text == i].tolist()) == Counter(_buckets(t))


def test_resampling_equals_brute_force(spark, awkward, nothing):
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eins", "zwei", "été", "7", "Word"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(700)] + [(i, "alpha beta " * 30) for i in range(700, 900)]
    target = ["gamma delta " * 20, None, "été eins"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows, drawn = _brute_resample(docs, target)
    rank = {r[0]: i + 1 for i, r in enumerate(drawn)}
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    assert len(got) == len(rows)
    assert {tuple(r)[:4]: r["rank"] for r in got} == {r: rank.get(r[0]) for r in rows}
    # nulls, long texts, repeated rows, null ids, clashing columns; no target; no rows
    given = [(r.doc_id, r.text) for r in awkward.collect()]
    rows, drawn = _brute_resample(given, [])
    got = importance.resample(awkward, nothing).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows) and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))
    assert importance.resample(nothing, nothing).count() == 0


def test_ranks_with_ties_and_many_runs(spark):
    n = 5000
    scored = spark.range(n).select("id", F.lit(100).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"),
                                   F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).cast("long").alias("score")).repartition(13)
    want = {r.id: i + 1 for i, r in enumerate(sorted(scored.collect(), key=lambda r: (-r.score, r.id)))}
    for percent in (100, 25, 1, 0):
        got = {r.id: r["rank"] for r in importance.rank_top(scored, percent).collect()}
        assert got == {k: v if v <= percent * n // 100 else None for k, v in want.items()}


# ------------------------------------------------------------------ alignment

@pytest.fixture(scope="module")
def aligner():
    return alignment.load(*alignment.vocabulary_paths())


def _brute_align(aligner, text):
    """(a, b, groups, links) of a whole text by byte ranges; None without tokens."""
    if not text:
        return None
    a, b, data = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text), (" " + text).encode()
    if b"".join(aligner.bytes_a[i] for i in a) != data or b"".join(aligner.bytes_b[i] for i in b) != data:
        return None
    spans = []
    for ids, of in ((a, aligner.bytes_a), (b, aligner.bytes_b)):
        ends = np.cumsum([len(of[i]) for i in ids]).tolist()
        spans.append(list(zip([0, *ends], ends)))
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, low = [], 0
    for high in cuts:
        groups.append("|".join(",".join(str(i) for i, (_, e) in zip(ids, s) if low < e <= high) for ids, s in zip((a, b), spans)))
        low = high
    links = [(i, j) for i, (p, q) in zip(a, spans[0]) for j, (r, s) in zip(b, spans[1]) if max(p, r) < min(q, s)]
    return a, b, groups, links


def test_parts_encode_like_whole_texts(aligner):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 40))) for _ in range(2500)]
    texts += ["a" * 9000, " " * 9000 + "x", "word " * 20000, "<s> </s> <unk> <0x41>", " ", "  ", "a ", "a\n", "é ▁ b"]
    for text, got in zip(texts, aligner.encode_texts(texts)):
        want = _brute_align(aligner, text) if len(text) < 200 else (aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text))
        assert (got is None) == (want is None), text[:60]
        if got is not None:
            assert got[0].tolist() == want[0] and got[1].tolist() == want[1], text[:60]
    assert any(x is None for x in aligner.encode_texts(texts))


def _brute_corpus(aligner, docs):
    found = {t: _brute_align(aligner, t) for _, t in docs}
    count = Counter(p for _, t in docs if found[t] for p in set(found[t][3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for key, t in docs:
        if not found[t]:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = found[t]
        out.append((key, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot_pairs", [1 << 21, 10, 0])  # looked up, both ways, all joined
def test_alignment_equals_brute_force(spark, aligner, hot_pairs):
    rnd = random.Random(6)
    base = ["".join(rnd.choice("abcde tion ing THE 12 é🙂,.") for _ in range(rnd.randint(1, 80))) for _ in range(40)]
    docs = [(i, base[i % 40]) for i in range(90)] + [(1000 + i, base[0]) for i in range(60)] + [(2000, None), (2001, ""), (2002, "a▁b"), (2003, " ")]
    got = alignment.align_tokenizers(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), hot_pairs=hot_pairs).collect()
    assert sorted(map(tuple, got)) == sorted(_brute_corpus(aligner, docs))


def test_alignment_of_awkward_tables(spark, awkward, nothing):
    got = alignment.align_tokenizers(awkward)
    assert got.count() == awkward.count() and got.where("n_a = 0").count() == 2  # the null and the empty text
    assert got.where("doc_id = 7").distinct().count() == 1 and alignment.align_tokenizers(nothing).count() == 0


def test_links_survive_packing():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 5, 3000):
        pairs = np.unique(rnd.integers(0, 2**32, n, dtype=np.uint32))
        often = rnd.integers(1, 70000, len(pairs)).astype(np.uint32)
        a, b = alignment.unpack_links(alignment.pack_links(pairs, often))
        assert a.tolist() == pairs.tolist() and b.tolist() == often.tolist()


# ------------------------------------------------------------------ quality votes

def _quality_tables(spark, n=600):
    rnd = random.Random(8)
    words = ["the", "river", "stone", "walks", "over", "quiet", "hills", "and", "finds", "a", "small", "house"]

    def text(i):
        t = [rnd.choice(words) for _ in range(rnd.randint(15, 60))]
        if i % 5 == 0:
            return " ".join(w + rnd.choice(["$$$", "%%%"]) for w in t)
        if i % 5 == 1:
            return " ".join(w for w in t[:6] for _ in range(9))
        return " ".join(t)

    docs = [(i, text(i)) for i in range(n)]
    return docs, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 5 > 1)) for i in range(n)], "doc_id long, quality int")


def test_quality_on_held_out_rows(spark):
    docs, df, labels = _quality_tables(spark)
    got = {r.doc_id: r for r in quality.score_quality(df, labels).collect()}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i in got if got[i].held_out] and sorted(i for i in got if got[i].held_out) == held
    assert np.mean([got[i].predicted == (i % 5 > 1) for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    # held-out labels are never read
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score_quality(df, flipped).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-6 for i in got)


def test_votes_equal_all_cosines(spark):
    docs, df, labels = _quality_tables(spark, 200)
    model = quality.train(df, labels, neighbours=7)
    counts = np.stack([quality.Terms().counts(t) for _, t in docs[:60]] + [quality.Terms().counts("")])
    got = model.vote(counts)
    for row, score in zip(counts, got):
        e = model.project(row[None, :])[0].astype(float)
        cosines = sorted(((float(e @ v), y, w) for v, y, w in zip(model.vectors.astype(float), model.labels, model.stands_for)), reverse=True)[:7]
        weights = [(max(c, 0) ** quality.SHARPNESS * w, y) for c, y, w in cosines]
        total = sum(w for w, _ in weights)
        assert abs(score - (sum(w * y for w, y in weights) / total if total else model.prior)) < 1e-4


def test_quality_of_awkward_tables(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, q) for i, q in [(1, 1), (2, 1), (6, 0), (7, 0), (10, 0), (11, None), (None, 1), (8, 1), (8, 0)]], "doc_id long, quality int")
    got = quality.score_quality(awkward, labels)
    assert got.count() == awkward.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert got.where("doc_id IN (3, 4, 5)").select("score").distinct().count() == 1  # texts without words
    none = quality.score_quality(awkward, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert quality.score_quality(nothing, labels).count() == 0
