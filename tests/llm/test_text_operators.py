"""Toxicity, fingerprints, personal data and chats: brute force, round trips, held-out accuracy."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from dwkit.llm import chat, imatch, pii, toxicity

# ------------------------------------------------------------------ toxicity


def _toxicity_corpus(spark, n=900):
    rnd = random.Random(1)
    plain = ["".join(rnd.choice(["an", "the", "or", "sh", "ti", "ou"]) for _ in range(rnd.randint(2, 4))) for _ in range(300)]
    bad = ["grumbo", "snarkle", "zweck"]
    rows, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.15
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 120))]
        for _ in range(rnd.randint(1, 4) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad) + rnd.choice(["", "ish", "ers"]))
        rows.append((i, " ".join(words), int(toxic)))
        if rnd.random() < 0.5:
            labels.append((i, int(toxic)))
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
            spark.createDataFrame(labels + [(None, 1), (5000, None), labels[0]], "doc_id long, toxic int"), {r[0]: r[2] for r in rows})


def test_toxicity_held_out_accuracy(spark):
    docs, labels, truth = _toxicity_corpus(spark)
    got = toxicity.score_toxicity(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    hits = sum(r.predicted and truth[r.doc_id] for r in held)
    assert hits >= 0.95 * sum(truth[r.doc_id] for r in held) and hits >= 0.95 * sum(r.predicted for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    # labels of held-out rows are never read: turning them over changes nothing
    turned = labels.withColumn("toxic", F.when(toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, turned).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-12 for r in got)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(not r.predicted for r in got)


def test_toxicity_features_of_blocks_are_those_of_words(monkeypatch):
    texts = [None, "", "x", "ab ab_abc1abcd-abcde", "ΑΣ ΣΑΣΣΑΣ İstanbul \u212aelvin", "a" * 70 + " " + "é" * 33 + "x", "\U0001d518\U0001d52b\U0001d526code \ud800abcd",
             "дом домами 中文字符中文 한국어 ١٢٣abc", " ".join(f"word{c}{d}s" for c in "abcdefgh" for d in "ijklmnop")] * 40
    exp = [{f for w in toxicity.WORD.findall((t or "").lower()) for f in toxicity.word_features(w)} for t in texts]
    wanted = np.array(sorted(set().union(*exp))[::3] + [2 ** 32 - 1], dtype=np.int64)
    for chars, rows in ((1 << 19, 256), (9, 7), (1, 1)):  # texts cut into pieces, and many texts in one
        monkeypatch.setattr(toxicity, "BLOCK_CHARS", chars)
        monkeypatch.setattr(toxicity, "BLOCK_ROWS", rows)
        got = [set() for _ in texts]
        for row, f in toxicity._features(texts):
            for i, x in zip(row.tolist(), f.tolist()):
                got[i].add(x)
        assert got == exp
        place, at = toxicity._rows_of(texts, wanted)
        assert [wanted[place[i:j]].tolist() for i, j in zip(at, at[1:])] == [sorted(e & set(wanted.tolist())) for e in exp]


def test_toxicity_counts_and_vectors(spark):
    docs = spark.createDataFrame([(1, "Der Hund und die Katze"), (2, "hund, Hunde; hund"), (3, None), (4, ""), (5, "hund, Hunde; hund")], "doc_id long, text string")
    texts = [r.text for r in docs.collect()]
    exp = collections.Counter(f for t in texts for f in {f for w in toxicity.WORD.findall((t or "").lower()) for f in toxicity.word_features(w)})
    assert {r.f: r.n for r in toxicity.count_features(docs).collect()} == exp
    some = np.array(sorted(exp)[::2], dtype=np.int64)
    assert {r.f: r.n for r in toxicity.count_features(docs, spark.sparkContext.broadcast(some)).collect()} == {f: exp[f] for f in some.tolist()}
    found = {tuple(np.frombuffer(bytes(r.v), dtype=np.uint16).tolist()): r.n for r in toxicity.vectors(docs, some).collect()}
    assert found == collections.Counter(tuple(i for i, f in enumerate(some.tolist()) if f in {f for w in toxicity.WORD.findall((t or "").lower()) for f in toxicity.word_features(w)}) for t in texts)


def test_toxicity_cases(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_toxicity(awkward, none).collect()
    assert len(got) == awkward.count() and all(r.score == 0.0 and r.predicted == 0 for r in got)
    labels = spark.createDataFrame([(i, int(i == 9)) for i in range(1, 13)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(awkward, labels).where("score is null").count() == 0
    assert toxicity.score_toxicity(nothing, labels).count() == 0


def test_nnpu_recovers_the_prior():
    rnd = np.random.default_rng(3)
    # feature 0 marks positives, feature 1 is noise; P has 200 texts, U 800 with a quarter positives
    positive = np.concatenate([np.ones(200, dtype=bool), rnd.random(800) < 0.25])
    ones = [(i, 0) for i in range(1000) if positive[i] and rnd.random() < 0.9] + [(i, 1) for i in range(1000) if rnd.random() < 0.5]
    rows, columns = (np.array(x) for x in zip(*ones))
    is_p = np.arange(1000) < 200
    w, b = toxicity.fit_nnpu(rows, columns, is_p, 2, 0.25)
    x = np.bincount(rows, weights=w[columns], minlength=1000) + b
    prob = 1 / (1 + np.exp(-x))
    assert w[0] > 3 * abs(w[1]) and abs(prob[~is_p].mean() - 0.25) < 1e-6


# ------------------------------------------------------------------ fingerprints


def test_edited_fingerprints(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in imatch.edited_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        n = len(t) // 4
        nxt = rows[(k + 1) % len(rows)]
        assert got[i].n_chars == len(t) and got[i].next_id == nxt[0]
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - n] + nxt[1][:n]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    prints = collections.defaultdict(set)
    for i, t in rows:
        prints[t].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    better = sum(r.near_edited > r.near_next for r in got.values())
    assert better >= 0.95 * len(got) and np.mean([r.near_next for r in got.values()]) < 0.05


def test_fingerprint_cases(spark, awkward, nothing):
    got = imatch.edited_fingerprints(awkward).collect()
    assert len(got) == len({(r.doc_id, r.text or "") for r in awkward.collect()})
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint != by_id[8].fingerprint
    assert by_id[3].fingerprint == by_id[4].fingerprint and by_id[3].n_chars == 0
    assert by_id[12].next_id is None and by_id[None].next_id == 1  # null ids last, then around
    assert imatch.edited_fingerprints(nothing).count() == 0
    single = imatch.edited_fingerprints(spark.createDataFrame([(1, "only this")], "doc_id long, text string")).first()
    assert single.next_id == 1 and single.near_next == 1.0


def test_likeness_of_a_large_group_of_near_copies(spark):
    """A third of the rows are near copies: none of their terms lies in the band, likeness stays graded."""
    rnd = random.Random(8)
    common = [f"group{k}" for k in range(100)]
    rows = []
    for i in range(3006):
        if i % 9 < 3:
            t = list(common)
            for k in rnd.sample(range(100), 3):
                t[k] = f"other{rnd.randrange(1000)}"
        else:
            t = [f"word{int(4000 * rnd.random() ** 2)}" for _ in range(100)]
        rows.append((i, " ".join(t)))
    got = {r.doc_id: r for r in imatch.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    hot = [got[i] for i in got if i % 9 < 3]
    assert min(r.near_edited for r in hot) > 0.2 and np.mean([r.near_edited for r in hot]) > 0.5
    assert min(got[i].near_next for i in got if i % 9 < 2) > 0.6      # the next is a near copy too
    assert max(got[i].near_next for i in got if i % 9 == 2) < 0.2     # the next is another text
    others = [got[i] for i in got if i % 9 > 2]
    assert all(r.fingerprint[16] == "*" for r in hot) and all(r.fingerprint[16] == ":" for r in others)
    assert np.mean([r.near_edited > r.near_next for r in others]) > 0.95


def test_lexicon_band_and_bitmap_at_every_size(spark):
    rows = [(i, f"own{i} tenth{i % 10} pair{i // 2}") for i in range(600)]
    lex = imatch.lexicon(spark.createDataFrame(rows, "doc_id long, text string"))
    assert lex.count() == 300  # the pairs; a term in a tenth of the texts is over the band below 1,000 texts too
    assert all(16 * n <= imatch.lexicon_bits(n) for n in (1, 10**6, 10**7))


def test_document_frequency_counts_distinct_texts(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(f"word{rnd.randrange(500)}" for _ in range(8))) for i in range(1500)]
    rows += [(5000 + i, "alpha beta gamma") for i in range(700)] + [(6000, "alpha delta"), (6001, "beta alpha word1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lex = {r.term for r in imatch.lexicon(docs).collect()}
    alpha, gamma = (spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in ("alpha", "gamma"))
    assert alpha in lex and gamma not in lex  # three distinct texts hold alpha, one holds gamma


# ------------------------------------------------------------------ personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _passes(kind, s):
    d = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def _base(text):
    found = [(m.start(), list(BASE).index(k), f"{k}:{m.start()}:{m.end()}") for k, p in BASE.items() for m in re.finditer(p, text or "") if _passes(k, m.group())]
    return [x[2] for x in sorted(found)]


def test_pii_base_spans(spark, awkward):
    rnd = random.Random(2)
    odd = "01234567890123456789  ..--+()@@abAZ_%é🙂\n$\\"
    rows = [(i, "".join(rnd.choice(odd) for _ in range(rnd.randint(0, 120)))) for i in range(3000)]
    rows += [(9000, "1" * 50000), (9001, "a." * 20000 + "@b.c"), (9002, "+1" + " " * 50000), (9003, "a@" + "b." * 20000 + "c"),
             (9004, "4111 1111 1111 1111 " * 1000), (9005, "x@y.z " * 3000)]
    rows += [(r.doc_id, r.text) for r in awkward.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collections.Counter((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find_pii(docs).collect())
    want = collections.Counter()
    for i, t in rows:
        spans = _base(t)
        n = collections.Counter(s.split(":")[0] for s in spans)
        want[i, hashlib.sha256(",".join(spans).encode()).hexdigest(), n["email"], n["ip"], n["card"], n["phone"]] += 1
    assert got == want


def test_pii_extra_spans_and_redaction(spark, awkward, nothing):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s] for r in pii.find_pii(docs).collect()}
    secrets = [texts[i][int(a):int(b)] for i, found in spans.items() for k, a, b in found if k == "secret"]
    tokens = [m for t in texts.values() for m in re.findall(r'token = "[0-9a-f]+"', t or "")]
    assert set(tokens) <= set(secrets) and all(any(c.isdigit() for c in s) for s in secrets)
    for i, found in spans.items():
        assert {":".join(s) for s in found} >= set(_base(texts[i]))
    left = pii.redact(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    for r in left.collect():
        assert r.n_chars == len(r.text) and not _base(r.text)
        assert spans[r.doc_id] or r.text == texts[r.doc_id]
    out = {r.doc_id: r.text for r in pii.redact(awkward).collect()}
    assert out[9] == "mail [EMAIL] or [PHONE] now é🙂 [IP] and [CARD]" and out[3] is None and out[4] == ""
    assert pii.find_pii(nothing).count() == 0 and pii.redact(nothing).count() == 0


def test_boosting_separates_and_calibrates():
    cells = [dict(kind=k, digits=d, separators=s, size=1, keyword=w, edge=1, mixed=0, form=0, pos=90 if d >= 3 or w else 2, neg=3 if d >= 3 or w else 120)
             for k in (5, 6) for d in range(6) for s in range(4) for w in (0, 1)]
    trees = pii.boost(cells)
    cut = pii.calibrate(cells, trees, 0.9)
    chosen = [c for c in cells if pii.cell_score(c, trees) >= cut[c["kind"]]]
    assert {(c["digits"] >= 3 or bool(c["keyword"])) for c in chosen} == {True} and len(chosen) == sum(c["digits"] >= 3 or c["keyword"] for c in cells)
    assert pii.boost([]) == [] and pii.calibrate([], []) == {}


# ------------------------------------------------------------------ chats


def _chats(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in out.items()}


def test_chat_round_trip(spark):
    rnd = random.Random(8)
    marks = ["<|start|>", "<|message|>", "<|sep|>", "<|end|>", "&lt;", "&amp;", "&", "<", "|", "<|", "</s>[INST]", "é🙂", "text ", ""]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "a<|end|>", "", None]), rnd.choice([None, "".join(rnd.choice(marks) for _ in range(5))]))
            for c in range(60) for t in range(rnd.randint(1, 9))]
    rows += [(None, 1, "user", "no id"), (70, None, "assistant", "first"), (70, 0, "assistant", "second"), (70, 0, "assistant", "second")]
    rows += [(80, t, "assistant" if t % 3 else "user", "long " * 20) for t in range(1500)]
    data = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, turns long").repartition(4)
    formatted = chat.format_chats(data)
    got = {r.conv_id: r for r in chat.chat_digests(formatted).collect()}
    texts = {r.conv_id: r for r in formatted.collect()}
    want = _chats(rows)
    assert got.keys() == want.keys()
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss) and got[c].formatted_chars == len(texts[c].formatted)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        heads = texts[c].formatted.count(chat.START)
        assert heads == sum(1 for k, (r, _) in enumerate(turns) if not k or turns[k - 1][0] != r)  # same-role turns are merged
        assert len(texts[c].loss_spans) == sum(r == "assistant" for r, _ in turns)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.format_chats(empty)).count() == 0


@pytest.mark.parametrize("text", ["", "&", "&amp;lt;|", "<<||<|&lt;|>", "<|end|>&amp;"])
def test_escape_is_reversible(spark, text):
    row = spark.range(1).select(chat.escape(F.lit(text)).alias("e"), chat.unescape(chat.escape(F.lit(text))).alias("u")).first()
    assert "<|" not in row.e and row.u == text


def test_redact_keeps_columns_of_any_name(spark, nothing):
    rows = [(1, "write to bob@example.com now", 28, "t1", ["s1"], "c1", "r1"), (2, None, None, "t2", None, "c2", "r2"), (2, None, None, "t2", None, "c2", "r2"),
            (3, "", 0, "t3", ["s3"], None, "r3"), (None, "plain words", 11, "t4", ["s4"], "c4", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, _text string, _spans array<string>, _candidates string, _r0 string")
    got = pii.redact(df)
    assert got.schema.names == df.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in df.schema]
    want = [(1, "write to [EMAIL] now", 20, "t1", ["s1"], "c1", "r1"), *rows[1:]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert pii.redact(nothing).collect() == []


def test_lexicon_does_not_depend_on_the_bitmap_of_repeats(spark, monkeypatch):
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    texts = [" ".join(rnd.sample(words, 30)) for _ in range(300)]
    df = spark.createDataFrame([(i, texts[i % 220]) for i in range(500)], "doc_id long, text string")
    band = (0.5, 6.0)
    want = sorted(r.term for r in imatch.lexicon(df, idf_band=band).collect())
    monkeypatch.setattr(imatch, "REPEATED_BITS", 64)  # nearly every text passes
    assert want and sorted(r.term for r in imatch.lexicon(df, idf_band=band).collect()) == want
