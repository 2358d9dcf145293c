"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib

import corpus_pipeline
from attriflux.llm import (
    bit_sliced, compression_quality, license_scan, line_quality, mixing, packing, pii, repeats, sharding, simhash)

N = 11


def test_packing(edge_docs):
    rows = packing.pack_documents(edge_docs).collect()
    assert {r.doc_id for r in rows if r.sequence_id is None} == {1, 2, 3}
    assert sum(r.n_words for r in rows if r.doc_id == 7) == 2 * 63 + 32
    assert len({r.piece for r in rows if r.doc_id == 5}) == 5
    assert packing.pack_documents(edge_docs.limit(0)).count() == 0


def test_license_scan(edge_docs):
    rows = {(r.doc_id, r.n_words) for r in license_scan.scan_licenses(edge_docs).collect()}
    assert {(1, 0), (2, 0), (3, 0), (4, 1), (None, 120)} <= rows
    assert license_scan.scan_licenses(edge_docs.limit(0)).count() == 0


def test_sharding(edge_docs):
    rows = sharding.shard_documents(edge_docs, shards=3).collect()
    assert len(rows) == N and {r["size"] for r in rows if r.doc_id in (1, 2)} == {16}
    for shard in range(3):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_documents(edge_docs.limit(0)).count() == 0


def test_line_quality(edge_docs, spark):
    model = line_quality.train_line_model(edge_docs, spark.createDataFrame([(5, 1)], "doc_id long, quality int"))
    assert model == line_quality.ALL_CONTENT
    rows = line_quality.line_quality(edge_docs, model).collect()
    assert len(rows) == N and all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 4))
    kept = line_quality.keep_content(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.kept for r in rows)
    assert line_quality.line_quality(edge_docs.limit(0), model).count() == 0


def test_simhash(edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == N and {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert simhash.near_duplicates(edge_docs.limit(0)).count() == 0
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 7, 8]
    assert simhash.keep_one(edge_docs.limit(0)).count() == 0


def test_bit_sliced(spark):
    rows = [(0, [0.5, -0.5]), (0, [0.5, -0.5]), (1, None), (2, [0.5, None]), (3, [float("nan"), 1.0]), (4, [1e9, 1.0]),
            (5, [0.5, -0.5]), (6, [0.5, -0.5]), (7, [0.25]), (None, [1.0, 1.0]), (8, [float("inf"), 0.0]), (50, [0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in bit_sliced.top_products(table, top=3).collect()}
    assert found == {(0, 1): (4, 128 * 256000000000 - 128 * 256), (0, 2): (5, 32768), (0, 3): (6, 32768),
                     (50, 1): (0, 0), (50, 2): (4, 0), (50, 3): (5, 0)}
    assert bit_sliced.top_products(table.limit(0)).count() == 0


def test_repeats(edge_docs):
    rows = repeats.remove_repeats(edge_docs).collect()
    assert len(rows) == N
    for r in rows:
        if r.doc_id in (5, 6):
            assert r.n_removed == r.n_bytes and r.kept_sha256 == hashlib.sha256(b"").hexdigest() and r.n_spans == 1
        if r.doc_id in (1, 2):
            assert (r.n_bytes, r.n_removed, r.n_spans) == (0, 0, 0)
    assert repeats.remove_repeats(edge_docs.limit(0)).count() == 0


def test_compression(edge_docs, spark):
    none = spark.createDataFrame([(5, 1), (7, None)], "doc_id long, quality int")
    assert compression_quality.train_compression_model(edge_docs, none) is None
    assert {r.score for r in compression_quality.score_quality(edge_docs, None).collect()} == {0.5}
    both = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, quality int")
    model = compression_quality.train_compression_model(edge_docs, both)
    rows = compression_quality.score_quality(edge_docs, model).collect()
    assert len(rows) == N and all(0 <= r.score <= 1 for r in rows)
    assert compression_quality.score_quality(edge_docs.limit(0), model).count() == 0


def test_personal_data(edge_docs):
    rows = pii.find_personal_data(edge_docs).collect()
    assert len(rows) == N and {(r.n_email, r.n_ip) for r in rows if r.doc_id == 8} == {(1, 1)}
    masked = pii.mask_personal_data(edge_docs, length_column="n_chars")
    assert masked.columns == edge_docs.columns
    out = {r.doc_id: r for r in masked.collect()}
    assert out[8].text.startswith("mail me at <EMAIL> or <IP> now") and out[8].n_chars == len(out[8].text)
    assert out[1].text is None and out[4].n_chars == 4
    assert pii.find_personal_data(edge_docs.limit(0)).count() == 0 and pii.mask_personal_data(edge_docs.limit(0)).count() == 0


def test_mixing(edge_docs):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == N and all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mixed_rows(edge_docs).columns == edge_docs.columns
    assert mixing.mixed_rows(edge_docs).count() == sum(r.times for r in rows)
    assert mixing.mix(edge_docs.limit(0)).count() == 0 and mixing.mixed_rows(edge_docs.limit(0)).count() == 0


def test_stages(edge_docs, spark, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, 1), (None, None), (7, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for docs in (edge_docs, edge_docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
