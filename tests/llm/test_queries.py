"""The registered queries and the pipeline on the small tables; SQL where there is some."""

import duckdb
import pandas as pd

import corpus_pipeline
from conftest import SF_SMALL
from dwkit.llm.queries import QUERIES, SQL

CONTRACT = {
    1: {"doc_id", "held_out", "score", "predicted"}, 2: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    3: {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    4: {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    5: {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}, 6: {"doc_id", "n_shingles", "component_id", "kept"},
    7: {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    8: {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}, 9: {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    10: {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    11: {"doc_id", "n_features", "weight", "score", "rank"},
    12: {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}, 13: {"doc_id", "held_out", "score", "predicted"}}


def test_one_query_per_operator_with_its_columns(spark):
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for key, fn in QUERIES.items():
        n = int(key[2:].split("_")[0])
        if n in (1, 3, 4, 6, 8):  # these start jobs; their own tests check columns and values
            continue
        got = fn(spark, SF_SMALL)
        assert CONTRACT[n] <= set(got.columns), key
        if n in (2, 5, 9, 11, 12, 13):
            assert got.count() == docs.count()


def test_queries_equal_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for key, sql in SQL.items():
        a, b = QUERIES[key](spark, SF_SMALL).toPandas(), con.execute(sql).df()
        columns = sorted(a.columns)
        order = [c for c in ("doc_id", "conv_id") if c in columns]
        pd.testing.assert_frame_equal(a[columns].sort_values(order).reset_index(drop=True), b[columns].sort_values(order).reset_index(drop=True), check_dtype=False)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("toxic = 1").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_copies", "near_copies", "personal_data", "packing"]
    left, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = spark.createDataFrame(stage(spark, left, SF_SMALL).collect(), docs.schema)
        assert left.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in left.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    gone = set(texts) - set(kept["toxicity"])
    assert len(gone) <= 0.3 * len(texts) and (not gone or len(gone & labels) > 0)
    norm = {i: " ".join(t.split()) for i, t in kept["toxicity"].items()}
    assert len(set(norm.values())) == len(kept["exact_copies"]) and set(kept["exact_copies"]) <= set(norm)
    assert {norm[i] for i in kept["exact_copies"]} == set(norm.values())
    assert set(kept["near_copies"]) == set(kept["personal_data"]) <= set(kept["exact_copies"])
    assert not any("@mail" in t for t in kept["personal_data"].values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, SF_SMALL).toPandas()
    assert set(pieces.doc_id) == set(kept["personal_data"]) and (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert corpus_pipeline.run(spark, SF_SMALL).agg({"length": "sum"}).first()[0] == pieces.length.sum()


def test_pipeline_stages_on_awkward_and_empty_tables(spark, awkward, nothing, tmp_path):
    """Nulls, empty and long texts, repeats, clashing column names, and no rows at all, through every stage."""
    spark.createDataFrame([(i, int(i == 9)) for i in range(1, 13)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    wide = awkward.withColumnRenamed("n", "n_chars").withColumns({"_text": awkward["t"], "_spans": awkward["c"], "_sha": awkward["g"], "_copy": awkward["a"]})
    for docs in (wide, nothing):
        left = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, left, str(tmp_path))
            assert got.columns == docs.columns, name
            left = spark.createDataFrame(got.collect(), docs.schema)
        pieces = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path))
        assert pieces.select("doc_id").distinct().count() == left.select("doc_id").distinct().count()
    kept = {r.doc_id for r in left.collect()}
    assert kept == set()  # the empty table comes last


def test_stages_bound_the_rows_of_a_batch(spark):
    from dwkit.session import BATCH_ROWS, bound_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        docs, seen = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
        for stage, fn in corpus_pipeline.STAGES:
            if stage in ("toxicity", "near_copies", "packing"):
                spark.conf.set(name, "10000")
                fn(spark, docs.limit(20), SF_SMALL)
                seen[stage] = int(spark.conf.get(name))
        assert set(seen.values()) == {BATCH_ROWS}
        spark.conf.set(name, "7")
        bound_batches(spark)
        assert spark.conf.get(name) == "7"
    finally:
        spark.conf.set(name, before)
