"""BPE transducer, token counts and packing against the tokenizer libraries."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import pytest

from dwkit.llm import byte_bpe, bpe_stream, packing, token_counts

ODD = " \n\t\r\x0b'sltvmrd\x1c\x85\xa0　aàé1²½.,!<|endoftext|>𝔸🙂中ア\x00_-(){}"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_stream.vocabulary_path())


def _odd_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


LONG = ["a" * 9000, "ab" * 6000, " " * 9000 + "x", "=-" * 4000, "the" * 4000, "é" * 5000, "word " * 20000]


def test_encoder_equals_library(library):
    codec = byte_bpe.load(bpe_stream.vocabulary_path())
    for text in _odd_texts(1500, 1) + LONG:
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_tokens_are_stable_beyond_the_lookahead():
    codec = byte_bpe.load(bpe_stream.vocabulary_path())
    table, rnd = codec.table, random.Random(3)
    assert 0 < table.lookahead < 1000
    for _ in range(60):
        data = "".join(rnd.choice("abcdeinorst") for _ in range(table.lookahead + 400)).encode()
        cut = rnd.randint(table.lookahead + 50, len(data) - 1)
        whole, part = table.merge(data), table.merge(data[:cut])
        end = 0
        for x, y in zip(whole, part):
            end += len(table.token_bytes[y])
            if end >= cut - table.lookahead:
                break
            assert x == y
    # fed byte by byte through a small window
    stream = byte_bpe.StreamEncoder(table, window=16)
    data = b"antidisestablishmentarianism" * 60
    out = [t for i in range(0, len(data), 7) for t in stream.feed(data[i:i + 7])]
    assert out + stream.finish() == table.merge(data) and len(stream.held) == 0


def test_decoder_waits_for_split_characters():
    codec = byte_bpe.load(bpe_stream.vocabulary_path())
    ids = codec.encode("é🙂中 tail")
    d = byte_bpe.StreamDecoder(codec)
    assert "".join(d.feed([i]) for i in ids) + d.finish() == "é🙂中 tail"


def test_encoding_digests(spark, awkward, nothing, library):
    rows = awkward.collect()
    got = bpe_stream.encoding_digests(awkward).collect()
    want = []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe_stream.encoding_digests(nothing).count() == 0
    trip = awkward.where("text is not null").select("text", bpe_stream.decode_column(bpe_stream.encode_column("text")).alias("back"))
    assert trip.where("text != back").count() == 0


def test_token_counts_equal_library(spark, awkward, nothing):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary_path())
    own = token_counts.load(token_counts.vocabulary_path())
    for text in _odd_texts(3000, 2) + LONG + ["▁a ▁ b", "x" + " " * 40 + "y", "<s> </s> <unk> <0x41>"]:
        assert own.count(text) == len(lib.encode(text)), text[:60]
    assert all(lib.encode(w.replace("▁", " ").lstrip(" ")) for w in list(own.whole)[:50] if w.strip("▁"))
    got = token_counts.token_counts(awkward, limit=4096).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(lib.encode(r.text or "")), len(lib.encode(r.text or "")) > 4096) for r in awkward.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_counts.token_counts(nothing).count() == 0


def _check_pieces(pieces, docs):
    """pieces: (doc, start, length, crc, doc_tokens, sequence, offset, ...); docs: key -> ids as bytes."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        data = docs[p[0]]
        assert p[4] == len(data) // 4 and p[3] == zlib.crc32(data[4 * p[1]:4 * (p[1] + p[2])]) and p[2] > 0
        by_doc[p[0]].append((p[1], p[2]))
        by_seq[p[5]].append((p[6], p[2]))
    for key, data in docs.items():
        at = 0
        for start, length in sorted(by_doc[key]):
            assert start == at
            at += length
        assert at == len(data) // 4
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0  # full, or a power of two: nothing is padded


def test_packer_places_every_token_once():
    rnd = random.Random(5)
    for _ in range(80):
        packer = packing.Packer(0, queue_tokens=rnd.choice([0, 5000, 10**6]), step_tokens=5000)
        docs = {i: rnd.randbytes(4 * rnd.choice([1, 5, 100, 256, 300, 512, 513, 700, 1023, 1024, 1025, 3000])) for i in range(rnd.randint(0, 50))}
        for i, data in docs.items():
            packer.add(i, data)
        packer.finish()
        _check_pieces(packer.out, docs)
        groups = defaultdict(int)
        for p in packer.out:
            groups[p[8]] += p[2]
        assert all(abs(n - 5000) <= 1024 for g, n in groups.items() if g != max(groups))


def test_pack(spark, awkward, nothing, library):
    docs = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = packing.pack(docs).collect()
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id] = struct.pack(f"<{len(ids)}I", *ids)
    _check_pieces([tuple(r) for r in got], want)
    assert packing.pack(awkward).agg({"length": "sum"}).first()[0] > sum(len(x) // 4 for x in want.values())  # repeats and null ids too
    assert packing.pack(nothing).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, tiers=(1000, 500))


def test_long_texts_of_any_kind_leave_in_small_blocks(library):
    codec = byte_bpe.load(bpe_stream.vocabulary_path())
    rnd = random.Random(9)
    odd = "".join(rnd.choice("🙂中é!\x1c ab\n") for _ in range(200_000))
    texts = [odd, "🙂" * 60_000, "中文" * 100_000, "abc" * 150_000, "=" * 400_000, " " * 300_000 + "🙂", "word " * 60_000 + "🙂", "!\x1c" * 90_000, "x" * 70_000 + " " + "y" * 200_000]
    for text in texts:
        blocks = list(codec.blocks(text))
        assert [t for block in blocks for ids in block for t in ids] == library.encode(text, add_special_tokens=False).ids, text[:20]
        assert max(sum(map(len, block)) for block in blocks) <= 2 * byte_bpe.BLOCK_CHARS + 2
