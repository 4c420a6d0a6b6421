"""One query per operator, over its whole table, with the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql:
            SQL[key] = sql
        return fn
    return deco


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


@query("op2_bpe_stream")
def op2(spark, d):
    from .bpe_stream import encoding_digests

    return encoding_digests(documents(spark, d).select("doc_id", "text"))


@query("op5_exact_dedup", """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm""")
def op5(spark, d):
    from .exact_dedup import exact_dedup

    return exact_dedup(documents(spark, d))


@query("op10_chat_format", """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS et, replace(replace(role, '&', '&amp;'), '<|', '&lt;|') AS er,
        coalesce(lag(role) OVER w = role, false) AS again FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
a AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
        sum(length(et) + CASE WHEN again THEN 7 ELSE 9 + length(er) + 11 + 7 END) AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars FROM a""")
def op10(spark, d):
    from .chat import chat_digests, format_chats

    conversations = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_digests(format_chats(conversations.unionByName(fixed)))


@query("op7_packing")
def op7(spark, d):
    from .packing import pack

    return pack(documents(spark, d))


@query("op9_token_counts")
def op9(spark, d):
    from .token_counts import token_counts

    return token_counts(documents(spark, d))


@query("op4_pii")
def op4(spark, d):
    from .pii import find_pii

    return find_pii(documents(spark, d))


@query("op3_imatch")
def op3(spark, d):
    from .imatch import edited_fingerprints

    return edited_fingerprints(documents(spark, d))


@query("op1_toxicity_nnpu")
def op1(spark, d):
    from .toxicity import score_toxicity

    return score_toxicity(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet"))


@query("op6_minhash_hamming")
def op6(spark, d):
    from .minhash import near_duplicates

    return near_duplicates(documents(spark, d), words=4)


@query("op8_previous_factors")
def op8(spark, d):
    from .repeats import remove_repeats

    return remove_repeats(documents(spark, d))


# CRC-32 as a fold over bytes: a number is folded in, -1 shifts by one bit (fixed value: the reversed polynomial).
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_FEATURES = """SELECT {key}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM (SELECT {key}, {words} AS w FROM {table}) q"""


@query("op11_importance_resampling", f"""
WITH df AS ({_FEATURES.format(key='doc_id', words=_WORDS, table='documents')}), tf AS ({_FEATURES.format(key='item_id', words=_WORDS, table='benchmark')}),
names AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM tf) u),
steps AS (SELECT f, flatten(list_transform(range(0, CAST(len(x) / 2 AS BIGINT)), lambda i: [CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS l FROM names),
buckets AS (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), l),
  lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295) % 10000 AS bucket FROM steps),
s AS (SELECT bucket, count(*) AS n FROM df JOIN buckets USING (f) GROUP BY 1), t AS (SELECT bucket, count(*) AS n FROM tf JOIN buckets USING (f) GROUP BY 1),
gains AS (SELECT s.bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM s) + 10000 AS DOUBLE)
  / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM df JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY 1),
sc AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
  (CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM documents d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM sc WHERE n_features >= 39)
SELECT sc.*, CASE WHEN k <= 25 * n // 100 THEN k END AS rank FROM sc LEFT JOIN r USING (doc_id)""")
def op11(spark, d):
    from .importance import resample

    return resample(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


@query("op12_tokenizer_alignment")
def op12(spark, d):
    from .alignment import align_tokenizers

    return align_tokenizers(documents(spark, d))


@query("op13_quality_neighbours")
def op13(spark, d):
    from .quality import score_quality

    return score_quality(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet"))
