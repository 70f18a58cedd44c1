"""The registered queries over the given tables, where rules or learning are involved."""

import base64
import hashlib
import zlib

import numpy as np

import corpus_pipeline
from climgrid.llm.queries import QUERIES, table, tokenizer
from tests.llm import plain


def texts(spark, sf):
    return [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]


def test_quality_rules(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, sf).collect()}
    assert all(tuple(got[d])[1:6] == plain.statistics(t) for d, t in texts(spark, sf))
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    seen = [(labels[d], r.kept) for d, r in got.items() if labels.get(d) is not None and not r.base_failed]
    assert np.mean([bool(q) == k for q, k in seen]) > 0.95


def test_near_dedup(spark, sf):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_minhash_near_dedup"](spark, sf).collect()}
    assert got == plain.near_components(texts(spark, sf))


def test_packing(spark, sf):
    out = QUERIES["op3_hilbert_packing"](spark, sf).collect()
    assert {r.doc_id for r in out} == {d for d, _ in texts(spark, sf)}
    used = sum(r.length for r in out)
    assert used > 0.97 * 2048 * len({r.sequence_id for r in out})


def test_token_queries_give_the_ids_of_the_plain_library(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = [(3, "one <|endoftext|> two"), (1, "<|startoftext|>a b"), (2, "plain text"), (4, None), (5, "<|endoftext|><|endoftext|>")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    digests = {}
    for name, end in (("word_bpe_49k.json", 1), ("byte_bpe_50k.json", 0)):
        encode = Tokenizer.from_file(tokenizer(name))
        ids = {d: [*encode.encode(t or "", add_special_tokens=False).ids, end] for d, t in rows}
        digests[name] = {d: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids.items()}
    packed = QUERIES["op3_hilbert_packing"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packed} == digests["word_bpe_49k.json"]
    stage = corpus_pipeline.pack_sequences(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)).collect()
    assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in stage} == digests["word_bpe_49k.json"]
    stored = sorted(QUERIES["op9_arrow_tokens"](spark, str(tmp_path)).collect())
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in stored} == digests["byte_bpe_50k.json"]
    assert [r.start for r in stored] == [0, *np.cumsum([r.n_tokens for r in stored])[:-1].tolist()]


def test_substrings(spark, sf):
    out = QUERIES["op4_substring_dedup"](spark, sf)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()) == sorted(plain.without_repeats(texts(spark, sf)))


def test_mixing(spark, sf):
    out = QUERIES["op5_cube_mixing"](spark, sf)
    source = {r.doc_id: r.source for r in table(spark, sf, "documents").collect()}
    total, target = {}, {}
    for r in out.collect():
        total[source[r.doc_id]] = total.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(total[s] / target[s] - 1) < 0.1 for s in total)


def test_language(spark, sf):
    lang = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    out = [r for r in QUERIES["op6_centroid_language"](spark, sf).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in out)
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in out]) > 0.98


def test_quality_score(spark, sf):
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    out = [r for r in QUERIES["op7_qda_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([labels[r.doc_id] == r.predicted for r in out]) > 0.85  # a dozen bad rows to learn from, at the smallest size


def test_warc(spark, sf):
    pages = [(r.page_id, r.html or "") for r in table(spark, sf, "pages").collect()]
    first = {}
    for p, h in sorted(pages):
        first.setdefault(h, p)
    digest = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    want = [(p, len(h.encode()), digest(h), *(("response", -1) if first[h] == p else ("revisit", first[h]))) for p, h in pages]
    out = QUERIES["op8_dictionary_warc"](spark, sf).collect()
    assert sorted(want) == sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in out)


def test_pipeline(spark, sf, tmp_path):
    docs = source = spark.read.parquet(f"{sf}/documents.parquet")
    counts = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == source.dtypes
            counts.append(docs.count())
    assert source.count() > counts[0] > counts[1] == counts[2]
    assert sorted(map(tuple, docs.drop("ids").collect())) == sorted(map(tuple, corpus_pipeline.run(spark, sf).drop("ids").collect()))
