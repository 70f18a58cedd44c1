"""Null values, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from climgrid.llm import (
    language, media, mixing, near_dedup, packing, quality_rules, quality_score, substrings, token_files, warc,
)
from climgrid.llm.queries import tokenizer
from climgrid.storage import work_folder
from tests.llm import plain

random.seed(5)
VOCABULARY = ["the", "of", "Ar", "é", "zu", "lorem", "ipsum", "x1", "a", "Bc", "dolor,", "sit.", "amet"]
PROSE = " ".join(random.choice(VOCABULARY) + str(random.randint(0, 400)) for _ in range(300))
LONG = " ".join(random.choice(VOCABULARY) for _ in range(60_000))
SHAPE = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, component_id long, "
    "starts string, `a.b` int, rule int, bucket long, place long, row long, key string, media string"
)
TEXTS = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE.upper()), (4, PROSE + " more words here"), (5, None), (6, ""), (7, " \n\t "),
    (8, "two words"), (9, "Two words"), (None, PROSE), (None, None), (10, LONG), (11, "start " + LONG), (12, "y" * 300_000),
    (13, "a b c d e f g h i j k l m"), (14, "a b c d e f g h i j k l m"), (15, "x a b c d e f g h i j k l m y a b c d e f g h i j k l m"),
    (16, "line\nline\n\nline two\n" * 20), (17, "#" * 50 + " | $ " * 60), (18, "Ünï    çø 中文 🙂\x01 don't 12 <|endoftext|>"), (19, "123 456 ..."),
]
LANG = {5: "de", 8: None, 10: "en", 11: "en"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (d, t, LANG.get(d, "fr"), None if d in (5, 9) else f"s{(d or 0) % 3}", None if t is None else len(t), False, 7, 8, "s", i, None, 1, 2, 3, "k", None)
        for i, (d, t) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SHAPE).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(d, int(d not in (16, 17))) for d, _ in TEXTS if d] + [(None, 1), (1, None), (99, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int")


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_quality_rules(docs, labels, empty):
    out = quality_rules.quality_rules(docs, labels)
    assert rows_of(out, "doc_id", *quality_rules.COUNTS) == sorted(((d, *plain.statistics(t)) for d, t in TEXTS), key=repr)
    for r in out.collect():
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.kept and r.base_failed)
    kept = quality_rules.reject_bad(docs, labels)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id") == rows_of(out.where("kept"), "doc_id")
    assert quality_rules.quality_rules(empty, labels.limit(0)).count() == 0


def test_near_duplicates(docs, empty):
    out = near_dedup.near_duplicates(docs)
    want = plain.near_components(TEXTS)
    got = rows_of(out, "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(
        ((d, *want[d], d == want[d][1]) if d is not None else (None, len(plain.shingles(t)), None, True) for d, t in TEXTS), key=repr
    )
    kept = near_dedup.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    assert rows_of(kept, "doc_id") == rows_of(out.where("kept"), "doc_id")
    assert near_dedup.near_duplicates(empty).count() == 0


def test_substrings_tell_texts_of_one_id_apart(spark):
    """Repeated ids with other texts: short, empty, null, repeating, and repeating nothing."""
    w = [f"w{i}" for i in range(400)]
    rows = [
        (1, " ".join(w[:60])), (2, " ".join(["x", *w[10:50], "y"])), (2, "three short words"), (2, ""), (2, None), (2, " ".join(w[200:260])),
        (2, " ".join(w[:30])), (3, " ".join(w[205:240])), (3, " ".join(w[300:330])), (4, " ".join(w[:60])), (4, " ".join(w[:60])), (4, "a " * 30),
        (None, " ".join(w[300:330])), (5, " ".join(w[295:340])), (5, " ".join(w[200:212])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = substrings.without_repeats(docs).drop("kept_text").collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, plain.without_repeats(rows)))
    want = Counter((d, x) for d, _, _, x in plain.without_repeats(rows))
    cut = Counter((d, hashlib.sha256(" ".join(plain.words(t)).encode()).hexdigest()) for d, t in substrings.cut_repeats(docs).collect())
    assert cut == want


def test_substrings(docs, empty):
    out = substrings.without_repeats(docs)
    assert rows_of(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(plain.without_repeats(TEXTS), key=repr)
    cut = substrings.cut_repeats(docs)
    assert cut.dtypes == docs.dtypes
    digest = lambda t: hashlib.sha256(" ".join(plain.words(t)).encode()).hexdigest()
    assert sorted(((r.doc_id, digest(r.text)) for r in cut.collect()), key=repr) == rows_of(out, "doc_id", "kept_sha256")
    assert all((r.text is None and r.n_chars is None) or r.n_chars == len(r.text) for r in cut.collect())
    assert substrings.without_repeats(empty).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    out = packing.pack(docs, path).collect()
    encode = Tokenizer.from_file(path)
    encode.encode_special_tokens = True
    whole = {}
    for r in sorted(out, key=lambda r: r.start):
        assert r.length * 4 == len(r.ids) and zlib.crc32(r.ids) == r.ids_crc32
    want = sorted((repr(d), len(encode.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in TEXTS)
    assert sorted((repr(r.doc_id), r.doc_tokens) for r in out if r.start == 0) == want
    assert sum(r.length for r in out) == sum(n for _, n in want)
    for r in out:
        whole.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in whole.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 2048
    assert sum(sum(n for _, n in p) < 2048 for p in whole.values()) <= 1
    assert packing.pack(empty, path).count() == 0
    total = packing.sequences(packing.pack(docs, path)).collect()
    assert sum(r["length"] for r in total) == sum(n for _, n in want) and all(len(r.ids) == 4 * r["length"] for r in total)


def test_mixing(docs, empty):
    out = mixing.mix(docs).collect()
    assert len(out) == len(TEXTS)
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in out)
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(empty).count() == 0 and mixing.mixed(docs).dtypes == docs.dtypes


def test_mixed_takes_each_row_as_often_as_the_mix(spark):
    rows = [(i, f"s{i % 3}", f"t{i} " * (20 + i % 7)) for i in range(60)]
    rows += [(None, f"s{i % 3}", f"n{i} " * (20 + i % 4)) for i in range(40)] + [(None, None, "null source"), (5, "s1", "other text of five " * 9)]
    rows += [(7, f"s{i % 2}", f"r{i} " * (20 + i % 2)) for i in range(30)] + [(8, "s2", "the same row " * 8)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    want, got = {}, {}
    for r in mixing.mix(docs).collect():
        want.setdefault((r["doc_id"], r["source"], r["size"]), []).append(r["copies"])
    out = Counter(map(tuple, mixing.mixed(docs).collect()))
    for row, n in Counter(rows).items():
        key = (row[0], row[1], len(plain.words(row[2])))
        each, more = divmod(out[row], n)
        got.setdefault(key, []).extend([each + 1] * more + [each] * (n - more))
    assert set(out) <= set(rows)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert Counter(map(tuple, mixing.mixed(docs.repartition(5)).collect())) == out


def test_language(docs, empty):
    model = language.fit(docs)
    out = language.identify(docs, model, reject=False)
    assert out.count() == len(TEXTS)
    for r in out.collect():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (5, 6, 7, 17, 19) or r.doc_id is None and r.score == 0)
    assert language.fit(empty) is None and language.identify(docs, None).where("lang_pred <> 'und'").count() == 0
    assert language.identify(empty, model).count() == 0


def test_language_counts_all_documents(spark):
    rows = [(i, f"l{i % 5}", f"{'abcde'[i % 5] * 3} word {i}") for i in range(400)] + [(None, "l0", "no id"), (1, None, "no language"), (2, "l1", "12")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    held = language.document_frequencies(docs)
    x, has = language.counts(pa.array([t for _, _, t in rows]))
    assert held[-1] == has.sum() == len(rows) - 1 and (held[:-1] == (x[has] > 0).sum(axis=0)).all()
    known = np.array([i is not None and v is not None for i, v, _ in rows]) & has
    want = language.inverse_frequency((x[known] > 0).sum(axis=0), int(known.sum()))
    for most in (20, 3):  # fewer rows than documents, and than languages
        model = language.fit(docs, fit_rows=most)
        assert (model.idf == want).all() and len(model.languages) == min(5, most) and len(model.centroids) <= most


def test_quality_score(docs, labels, empty):
    model = quality_score.fit(docs, labels)
    out = quality_score.score(docs, model).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert quality_score.fit(docs, labels.limit(0)) == 0.5
    assert quality_score.score(empty, model).count() == 0


def test_warc(spark):
    pages = [(3, "http://a/\n b", "<p>é</p>", 1), (1, None, "<p>é</p>", 2), (2, "u", None, 3), (4, "u", "", 4), (4, "u", "", 5), (None, "v", "x", 6), (None, "v", None, 7), (5, "w", "z" * 400_000, 8)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, refers_to long")
    folder = work_folder(spark, "warc")
    out = warc.read_archives(warc.write_archives(df, folder), folder)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    refers = {3: 1, 4: 2}
    want = [
        (p, len((h or "").encode()), digest(h), "revisit" if p in refers else "response", refers.get(p), None if p in refers else (h or "").encode())
        for p, _, h, _ in pages
    ]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert warc.read_archives(warc.write_archives(df.limit(0), f"{folder}-2"), folder).count() == 0


def test_warc_with_dictionary(spark):
    pages = [(i, f"http://host/{i}", f"<html><body>{'common words of all pages ' * 20}{i}</body></html>") for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    folder = work_folder(spark, "warc")
    files = warc.write_archives(df, folder)
    got = sorted((r.page_id, bytes(r.payload).decode()) for r in warc.read_archives(files, folder).collect())
    assert got == sorted((i, h) for i, _, h in pages)
    path = files.first().path
    with open(path, "rb") as f:
        assert int.from_bytes(f.read(4), "little") == warc.DICTIONARY_FRAME and int.from_bytes(f.read(4), "little") > 0
    with open(path, "r+b") as f:
        f.seek(-40, 2)
        f.write(b"\x00" * 8)
    with pytest.raises(Exception):
        warc.read_archives(files, folder).collect()


def test_token_files(spark, docs, empty):
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    path, folder = tokenizer("byte_bpe_50k.json"), work_folder(spark, "ids")
    files = token_files.write_tokens(docs, folder, path)
    got = sorted(map(tuple, token_files.read_tokens(files, folder).collect()), key=lambda r: r[1])
    encode = Tokenizer.from_file(path)
    encode.encode_special_tokens = True
    want = sorted((repr(d), zlib.crc32(np.array([*encode.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for d, t in TEXTS)
    assert sorted((repr(d), crc) for d, _, _, crc in got) == want
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    ids = [r[0] for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    name = max(files.collect(), key=lambda r: r.n_tokens).path
    with pa.memory_map(f"{name}.ids.arrow") as file:  # random access without a copy
        batch = pa.ipc.open_file(file).get_batch(0)
        before = pa.total_allocated_bytes()
        row = batch.column("ids").flatten()[2048:4096].to_numpy()
        assert len(row) == 2048 and pa.total_allocated_bytes() == before
    assert token_files.read_tokens(token_files.write_tokens(empty, f"{folder}-2", path), f"{folder}-2").count() == 0


def test_media(docs, empty):
    out = media.media_features(media.store_media(docs)).collect()
    pad = lambda b: b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
    want = sorted(repr((d, len((t or "").encode()), hashlib.sha256(pad((t or "").encode())).hexdigest())) for d, t in TEXTS)
    assert sorted(repr((r.doc_id, r.n_bytes, r.payload_sha256)) for r in out) == want
    assert len({bytes(r.hash) for r in out if r.doc_id in (5, 6)}) == 1
    assert media.media_features(media.store_media(empty)).count() == 0
