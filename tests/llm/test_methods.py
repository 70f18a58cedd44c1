"""Parts of the methods against plain or exhaustive versions."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from climgrid.llm import media, mixing, packing, quality_rules, quality_score, substrings
from climgrid.llm.graph import components
from climgrid.llm.near_dedup import Signer, near_duplicates
from climgrid.llm.queries import tokenizer
from climgrid.llm.text import UnitEncoder
from tests.llm import plain

PIECES = [" ", " ", "\n", "\t", "a", "the", "'", "'s", ".", ",", "!!", "é", "É", "22", "\x01", "中", " ", "_", "A", "The", "İ", "́", "<|endoftext|>", "\r", "\x85"]


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), min_size=1, max_size=20))
def test_units_give_the_ids_of_whole_texts(name, spaces, texts):
    encode = test_units_give_the_ids_of_whole_texts.made.setdefault(name, UnitEncoder(tokenizer(name), spaces))
    ids, bounds = encode(pa.array(texts))
    want = encode.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [w.ids for w in want]


test_units_give_the_ids_of_whole_texts.made = {}


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_added_tokens_are_those_of_the_library(name, spaces):
    from tokenizers import Tokenizer

    texts = ["one <|endoftext|> two", "no such", None, "<|endoftext|>", "<|startoftext|>x<|endoftext|>", "", "<|EndOfText|> <|end", " a<|endoftext|>\n\nb "]
    plainly = Tokenizer.from_file(tokenizer(name))
    for part in (texts, texts[:1], texts[1:3], texts[::-1]):
        ids, bounds = UnitEncoder(tokenizer(name), spaces, added=True)(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [plainly.encode(t or "", add_special_tokens=False).ids for t in part]


def test_signature_bins_agree_as_often_as_sets():
    rng, signer = np.random.default_rng(1), Signer()
    for size, common in ((4, 3), (40, 30), (800, 600)):
        agree = []
        for _ in range(200):
            h = rng.integers(0, 1 << 63, 2 * size - common, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(h[:size]), np.unique(h[size - common :])
            agree.append((signer.signature(a) == signer.signature(b)).mean())
        assert abs(np.mean(agree) - common / (2 * size - common)) < 0.05


def test_near_duplicates_by_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for group in range(12):
        base = [f"w{rng.integers(0, 5000)}" for _ in range(int(rng.integers(8, 160)))]
        for _ in range(int(rng.integers(1, 14))):
            words = [w if rng.random() > rng.choice([0.0, 0.01, 0.03, 0.06]) else f"n{rng.integers(0, 9999)}" for w in base]
            rows.append((len(rows), " ".join(words)))
    order = rng.permutation(len(rows)).tolist()
    rows = [(order[d], t) for d, t in rows]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain.near_components(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 240)] + [(300, 7), (7, 400), (400, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(200, 240)]}, 7: 7, 300: 7, 400: 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("most", [1, 7, 60, 1 << 16])
def test_components_whatever_a_task_contracts(spark, most):
    rng = np.random.default_rng(6)
    ends = rng.permutation(300)[rng.integers(0, 300, (230, 2))].tolist()
    root = list(range(300))
    for _ in root:
        for a, b in ends:
            root[a] = root[b] = min(root[a], root[b])
    edges = spark.createDataFrame(ends + ends[:40], "a long, b long").repartition(5)
    got = components(edges, most).collect()
    assert sorted((r.node, r.component) for r in got) == [(i, root[i]) for i in sorted({x for e in ends if e[0] != e[1] for x in e})]


def test_few_links_need_few_jobs(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)], "a long, b long").repartition(8)
    spark.sparkContext.setJobGroup("few links", "")
    try:
        assert {r.component for r in components(edges).collect()} == {0}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few links")) <= 10


def test_near_duplicates_when_no_bucket_shares_its_hub(spark):
    """Near copies of a text that differ from the hub by too much, but not from each other."""
    base = [f"w{i}" for i in range(100)]
    texts = [base[:], *([*base[:13 + k], *(f"x{i}" for i in range(13 + k, 100))] for k in range(4)), base[:80] + ["y"] * 20, base[:79] + ["y"] * 21]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(50 + i, t) for i, t in rows]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain.near_components(rows)


def test_hilbert_key_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), axis=-1).reshape(-1, n)
        key = packing.hilbert_key(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_passages_are_sought_over_whole_slices(monkeypatch):
    """Many short texts are one run of anchors; no window reaches from one text into the next,
    and texts without an id or of fewer words than a window have no anchor."""
    rng, calls = np.random.default_rng(3), []
    plain = substrings.choices
    monkeypatch.setattr(substrings, "choices", lambda grams, span: calls.append(1) or plain(grams, span))
    texts = [" ".join(map(str, rng.integers(0, 3, n))) for n in (40, 12, 13, 0, 30, 25)] + [None]
    ids = [5, 4, 4, 3, None, 1, 0]
    rows = lambda texts, ids: pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
    found = [r for b in substrings._anchors(13, 5)([rows(texts, ids)]) for r in b.to_pylist()]
    assert len(calls) == 1
    alone = [r for t, i in zip(texts, ids) for b in substrings._anchors(13, 5)([rows([t], [i])]) for r in b.to_pylist()]
    assert found == alone and {r["doc_id"] for r in found} == {5, 4, 1}


def test_equal_windows_choose_equal_anchors():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    a, b = (np.concatenate([rng.integers(0, 1 << 62, k, dtype=np.uint64), shared]) for k in (3, 17))
    ca, cb = substrings.choices(a, 9), substrings.choices(b, 9)
    assert ((ca[3:] - 3) == (cb[17:] - 17)).all()
    assert substrings.spans(np.array([0, 5, 18, 40]), 13).tolist() == [[0, 31], [40, 53]]


def test_flight_keeps_both_balances():
    rng = np.random.default_rng(4)
    for n in (3, 10, 500):
        p, size = rng.random(n), rng.integers(1, 900, n).astype(float)
        out = mixing.fly(p, size, 2, rng)
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert abs(out.sum() - p.sum()) < 1e-6 and abs(out @ size - p @ size) < 1e-3


def test_targets_share_what_small_sources_cannot_take():
    target = mixing.source_targets({"a": 10, "b": 1000, None: 100})
    assert target["a"] == 20 and target[None] <= 200 and abs(sum(target.values()) - 1.5 * 1110) < 1e-6
    assert mixing.source_targets({}) == {} and mixing.source_targets({"a": 0}) == {"a": 0.0}


def test_mix_is_near_its_targets(spark):
    rng = np.random.default_rng(6)
    rows = [(i, f"s{min(int(rng.exponential(2)), 6)}", " ".join(["w"] * int(rng.lognormal(4, 1.2)))) for i in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), block=256)
    for r in out.groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
        assert abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.02


def test_large_documents_are_settled_beside_a_hot_source(spark):
    """Of the small source 1.286 times 7000 words are wanted, of which one document has 3000."""
    rows = [(i, "b", "w " * 20) for i in range(600)] + [(1000 + i, "a", "w " * 20) for i in range(150)] + [(2000, "c", "w " * 3000)]
    rows += [(2001 + i, "c", "w " * (15 + i % 11)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for block in (64, 4096):
        out = mixing.mix(docs, weights=(1.0, 1.0, 1.0), share=1.286, block=block)
        for r in out.groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
            assert abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.01, (block, r)


def test_each_document_is_taken_as_often_as_expected():
    """Flight and landing over many seeds: both balances hold in each, probabilities on average."""
    rng = np.random.default_rng(12)
    for p in (np.full(12, 0.5), np.full(60, 0.3), rng.uniform(0.05, 0.95, 60)):
        size = np.sort(rng.integers(10, 400, len(p)).astype(float))[::-1]
        mean, n = np.zeros(len(p)), 1500
        for _ in range(n):
            x = mixing.fly(p, size, mixing.LANDING, rng)
            still = np.flatnonzero((x > 0) & (x < 1))
            x[still] = mixing.land(x[still], size[still], rng)
            assert set(x) <= {0.0, 1.0}
            assert abs(x @ size - p @ size) <= max(size[still], default=0) and abs(x.sum() - p.sum()) <= mixing.LANDING / 2
            mean += x / n
        assert np.abs(mean - p).max() < 0.06


def test_others_make_up_for_large_documents():
    rng = np.random.default_rng(13)
    p, size = np.array([0.3, 0.3, 0.8]), np.array([900.0, 700.0, 500.0])
    drawn = [mixing.settle(p, size, 0.4, 9000.0, rng) for _ in range(4000)]
    assert all(abs(x @ size + others * 9000 - (p @ size + 3600)) < 1e-6 for x, others in drawn)
    assert np.abs(np.mean([x for x, _ in drawn], axis=0) - p).max() < 0.04
    assert abs(np.mean([others for _, others in drawn]) - 0.4) < 0.01
    # what the others cannot make up for is not drawn: of 1000 tokens wanted one document has 3000
    assert all(mixing.settle(np.array([0.25]), np.array([3000.0]), 0.25, 1000.0, rng)[0].tolist() == [0.0] for _ in range(50))
    assert mixing.settle(np.array([0.6, 0.2]), np.array([10.0, 4.0]), 0.0, 0.0, rng)[0].tolist() == [0.0, 1.0]


def test_a_mix_follows_its_seed(spark):
    rows = [(i, f"s{i % 2}", "w " * (20 + i * 7 % 90)) for i in range(400)] + [(900 + i, "s1", "w " * 4000) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken = lambda seed, n: sorted(map(tuple, mixing.mix(docs.repartition(n), seed=seed, block=128).collect()))
    assert taken(0, 2) == taken(0, 5) != taken(1, 2)


def test_rules_find_a_conjunction():
    rng = np.random.default_rng(70)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = (x["a"] > 0.7) & (x["b"] <= 0.4)
    rules = quality_rules.learn_rules(x, bad)
    covered = np.any([r.holds(x) for r in rules], axis=0)
    assert (covered == bad).mean() > 0.98
    assert quality_rules.learn_rules(x, np.zeros(3000, bool)) == []


def test_discriminant_separates_a_ring_from_its_middle():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((2000, 3))
    y = ((x**2).sum(axis=1) < 2).astype(int)
    score = quality_score.train(x, y).score(x)
    assert ((score > 0.5) == y).mean() > 0.95


@pytest.mark.parametrize("kinds", [(0,), (1,), (2,), (3,), (4,), (0, 1, 2), (0, 1, 2, 3, 4), (4, 3, 1)])
def test_png_filters(kinds):
    rng = np.random.default_rng(9)
    for height in (1, 2, 70, 300):
        noise = rng.integers(0, 256, (height, 64), dtype=np.uint8)
        across, down = (np.add.accumulate(rng.integers(0, 7, (height, 64), dtype=np.uint8), axis=i, dtype=np.uint8) for i in (1, 0))
        mixed = np.where(rng.random((height, 1)) < 0.5, np.where(rng.random((height, 1)) < 0.5, across, noise), down)
        for x in (noise, across, down, mixed):
            lines = media.filtered(x, kinds)
            assert set(lines[:, 0]) <= set(kinds)
            each = [media._predicted(k, x).view(np.int8).astype(int) for k in kinds]
            least = np.min([np.abs(e).sum(axis=1) for e in each], axis=0)
            assert (np.abs(lines[:, 1:].view(np.int8).astype(int)).sum(axis=1) == least).all()
            png = media.encode_png(x.tobytes(), filters=kinds)
            assert (media.decode_png(png) == x).all()
            with pytest.raises(ValueError):
                media.decode_png(png[:60] + bytes([png[60] ^ 1]) + png[61:])


def test_stored_texts_are_filtered():
    lines = media.filtered(np.frombuffer(media.padded(b"words of a text, and others of it " * 40), np.uint8).reshape(-1, 64))
    assert (lines[:, 0] > 0).mean() > 0.9


def test_archives_and_token_files_are_read_a_task_a_file(spark, tmp_path):
    from climgrid.llm import token_files, warc
    from climgrid.llm.queries import tokenizer

    pages = spark.range(60).selectExpr("id AS page_id", "concat('http://a.org/', id) AS url", "repeat(cast(id % 7 AS string), 500) AS html").repartition(6)
    files = warc.write_archives(pages, str(tmp_path / "w"))
    read = warc.read_archives(files, str(tmp_path / "w"))
    assert read.rdd.getNumPartitions() == files.count() == 6 and read.count() == 60
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('words of ', id) AS text")
    files = token_files.write_tokens(docs, str(tmp_path / "t"), tokenizer("byte_bpe_50k.json"))
    read = token_files.read_tokens(files, str(tmp_path / "t"))
    assert read.rdd.getNumPartitions() == files.count() and read.count() == 300


def test_a_dictionary_of_few_records_is_their_bytes():
    from climgrid.llm import warc

    assert warc.train_dictionary([]) == b""
    few = warc.train_dictionary([b"a page " * 20, b"another page " * 30])
    assert few.endswith(b"another page ") and b"a page a page" in few
