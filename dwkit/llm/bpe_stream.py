"""BPE encoding and decoding of a text column (see ``byte_bpe`` for the transducer)."""

from __future__ import annotations

import hashlib
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import byte_bpe


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_column(text, path: str | None = None):
    """array<int> column of the token ids (null text: empty)."""
    path = path or vocabulary_path()

    @F.pandas_udf("array<int>")
    def run(s: pd.Series) -> pd.Series:
        codec = byte_bpe.load(path)
        return pd.Series([codec.encode(t or "") for t in s], dtype=object)

    return run(text)


def decode_column(ids, path: str | None = None):
    """Text of an array<int> column of token ids (null: empty text)."""
    path = path or vocabulary_path()

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        codec = byte_bpe.load(path)
        out = []
        for x in s:
            d = byte_bpe.StreamDecoder(codec)
            out.append(d.feed(x if x is not None else ()) + d.finish())
        return pd.Series(out, dtype=object)

    return run(ids)


def encoding_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 per row.

    Ids go block by block from the encoder into the digest and into the decoder, whose text
    goes into the second digest: a text's memory does not grow with its length.  Null text
    counts as empty (no tokens, digests of nothing).  Rows are independent: repeated rows and
    null ids stay as they are, other columns are not read, no rows give no rows.
    """
    path = path or vocabulary_path()

    def run(batches):
        codec = byte_bpe.load(path)
        decimal = {i: str(i) for i in codec.bytes_of}
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                ids_sha, text_sha, n, machine = hashlib.sha256(), hashlib.sha256(), 0, byte_bpe.StreamDecoder(codec)
                for block in codec.blocks(text or ""):
                    ids = list(chain.from_iterable(block))
                    if ids:
                        ids_sha.update((("," if n else "") + ",".join(map(decimal.__getitem__, ids))).encode())
                        text_sha.update(machine.feed(ids).encode())
                        n += len(ids)
                text_sha.update(machine.finish().encode())
                rows.append((n, ids_sha.hexdigest(), text_sha.hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"], index=pdf.index)
            out.insert(0, "id", pdf["id"])
            yield out

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInPandas(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
