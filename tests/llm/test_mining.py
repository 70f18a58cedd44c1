"""Hard negatives, URL filters and phrases against plain versions, with odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from climgrid.llm import negatives, phrases, url_filter
from climgrid.llm.queries import URL_RULES

# -- hard negatives --------------------------------------------------------------------------


def whole(v, scale=256):
    return [math.floor(scale * float(x)) for x in v]


def plain_negatives(rows, positives=5, negatives=10):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by brute force."""
    fine = [
        (i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, whole(v), k)
        for k, (i, v, lab) in enumerate(rows)
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    last = lambda s, i: (-s, i is None, i or 0)
    for a, lab, v, k in fine:
        if a is None or a % 100:
            continue
        scored = sorted(((sum(x * y for x, y in zip(v, w)), i, m) for i, m, w, j in fine if j != k), key=lambda r: last(r[0], r[1]))
        for ps, p, _ in [r for r in scored if r[2] == lab][:positives]:
            fit = [(s, i) for s, i, m in scored if m != lab and 30 * ps <= 100 * s <= 90 * ps][:negatives]
            out += [(a, p, r, i, ps, s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, kind="array<float>", **how):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int").repartition(3)
    off = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = negatives.mine_negatives(df, F.col("vec_id") % 100 == 0, off, **how)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.select(*names).collect()), key=repr)


@pytest.mark.parametrize("top", [100, 40_000, 1 << 31, 1 << 45, 1 << 70])
def test_packed_scores_are_exact(top):
    rng = random.Random(top)
    draw = lambda n: [[rng.randint(-top, top) for _ in range(7)] for _ in range(n)]
    kind = np.int64 if top < 1 << 62 else object
    a, c = np.array(draw(5), kind), np.array(draw(23), kind)
    packed = negatives.Packed(c, max(sum(map(abs, r)) for r in a.tolist()))
    if top == 100:
        assert packed.fields > 2
    got = packed.scores(a if packed.narrow else a.astype(object))
    assert got.tolist() == [[sum(x * y for x, y in zip(p, q)) for q in c.tolist()] for p in a.tolist()]


def test_order_of_numbers_of_any_size():
    rng = random.Random(4)
    numbers = [0, -1, 1, 127, 128, -128, -129, 255, 256, -256, *(rng.randint(-(1 << b), 1 << b) for b in range(1, 400) for _ in range(5))]
    assert sorted(numbers) == sorted(numbers, key=negatives._order)


def vectors(n, dims, seed, ties=False):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims)) + rng.normal(size=dims) * 0.5
    v /= np.linalg.norm(v, axis=1)[:, None]
    if ties:
        v = np.round(v * 4) / 4
    return [(i, [float(x) for x in v[i]], int(rng.integers(0, 4))) for i in range(n)]


def test_negatives_against_brute_force_in_several_blocks(spark):
    rows = vectors(420, 12, 1)
    got = mined(spark, rows, chunk_rows=90, group_anchors=2)
    as_floats = [(i, [float(np.float32(x)) for x in v], m) for i, v, m in rows]
    assert got == plain_negatives(as_floats) and len(got) > 30


def test_negatives_with_odd_rows(spark):
    rows = vectors(130, 5, 2, ties=True)
    rows += [(rows[3][0], rows[9][1], 2), (0, rows[11][1], 1), (100, rows[100][1], rows[100][2]), (100, rows[100][1], rows[100][2])]
    rows += [(None, rows[5][1], 1), (None, rows[5][1], 2), (200, None, 1), (300, [0.5] * 5, None), (400, [0.1, None, 0.2, 0.3, 0.4], 1)]
    rows += [(500, [float("nan")] * 5, 1), (600, [float("inf")] * 5, 1), (700, [0.0] * 5, 1), (800, [], 2), (900, [0.5, 0.5], 3)]
    assert mined(spark, rows, chunk_rows=40, group_anchors=3) == plain_negatives(rows)


@pytest.mark.parametrize("scale", [1e6, 1e30])
def test_negatives_with_large_components(spark, scale):
    rows = [(i, [x * scale for x in v], m) for i, v, m in vectors(120, 6, 3)]
    want = plain_negatives(rows)
    most = (1 << 63) - 1
    cut = sorted(((*r[:4], min(r[4], most), min(r[5], most)) for r in want), key=repr)
    assert mined(spark, rows, "array<double>") == cut and cut


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1)]) == []
    assert mined(spark, [(0, [0.5], 1)]) == []
    clashing = spark.createDataFrame([(0, [0.5], 1, 2, 3)], "vec_id long, embedding array<float>, label int, row int, chunk int")
    assert negatives.mine_negatives(clashing, F.col("vec_id") % 100 == 0).count() == 0


# -- URL filters -----------------------------------------------------------------------------


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules=URL_RULES):
    fits = [(len(h + p), h + p, what) for what, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def plain_ratio(urls, order):
    """Log-ratio per text from Witten-Bell models, computed by recursion."""
    count, follow = {"allow": Counter(), "block": Counter()}, {"allow": defaultdict(set), "block": defaultdict(set)}
    letters = set()
    for text, teaches in urls:
        padded = "\x02" * order + text + "\x03"
        for i in range(order, len(padded)):
            letters.add(padded[i])
            for k in range(order + 1):
                if teaches:
                    count[teaches][padded[i - k : i], padded[i]] += 1
                    follow[teaches][padded[i - k : i]].add(padded[i])
    total = {c: Counter() for c in count}
    for c in count:
        for (ctx, _), n in count[c].items():
            total[c][ctx] += n

    def p(c, ctx, x):
        below = p(c, ctx[1:], x) if ctx else 1 / (len(letters) + 1)
        n, t = total[c][ctx], len(follow[c][ctx])
        return (count[c][ctx, x] + t * below) / (n + t) if n else below

    def llr(text):
        padded = "\x02" * order + text + "\x03"
        return sum(math.log(p("allow", padded[i - order : i], padded[i]) / p("block", padded[i - order : i], padded[i])) for i in range(order, len(padded))) / (len(text) + 1)

    return llr


URLS = [
    "https://a.com/x", "http://EXAMPLE.com/en/1", "http://www.Example.com/en/1", "http://m.www.example.com/en/", "http://example.com/fr/",
    "http://x.net/es/1", "http://net/fr/1", "http://x.net/de/1", "http://x.org?q=/en/", "http://x.com?u=http://y.net/es/", "http://x.com#/",
    "http://x.com", "ftp://bücher.COM/ü", "no scheme", "", None, "://", "http:///es/", "http://net.es/", "http://anet/es/", "http://İ.com/", "a://b://c.com/",
    "http://x.org/" + "a%20" * 3000, "http://x.org/\n/en", "http://x.org/\x02\x03",
]


def test_urls_against_the_plain_rules_and_models(spark):
    rng = random.Random(8)
    made = [f"http://{rng.choice(['a', 'b.example', 'www.example', 'spam'])}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'es', 'fr'])}/{rng.randint(1, 50)}" for _ in range(150)]
    rows = [(i, u, "x") for i, u in enumerate(URLS + made + made[:20])] + [(None, "http://x.org/1", "y"), (3, "http://x.net/es/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, score string").repartition(3)
    out = url_filter.judge_urls(pages, URL_RULES, order=3)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "llr", "score"]
    got = out.collect()
    assert sorted((r.page_id, r.url) for r in got if r.page_id is not None and r.url) == sorted((r[0], r[1]) for r in rows if r[0] is not None and r[1])
    chars = F.col("_c")
    held = {r._c: r.h for r in spark.createDataFrame([(c,) for c in {chars_of(r.url) for r in got}], "_c string").select(chars, (F.pmod(F.xxhash64(chars), F.lit(4)) == 0).alias("h")).collect()}
    teaching = []
    for r in got:
        c = chars_of(r.url)
        teaching.append((c, None if held[c] else plain_rule(*plain_host_path(r.url))[1]))
    llr = plain_ratio(teaching, 3)
    for r in got:
        host, path = plain_host_path(r.url)
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("allow" if r.score >= 0.5 else "block")) and 0 <= r.score <= 1
        assert abs(r.llr - llr(chars_of(r.url))) < 1e-6


def chars_of(url):
    if url is None:
        return ""
    host, _ = plain_host_path(url)
    text = host + url.split("://", 1)[1][len(host) :] if "://" in url else url
    return re.sub("[\x02\x03]", " ", text)


def test_urls_rare_and_common_ngrams_meet_alike(spark, monkeypatch):
    rows = [(i, f"http://{'ab'[i % 2]}.{'com' if i % 3 else 'net'}/{'es' if i % 3 == 0 else 'en'}/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    want = sorted(map(tuple, url_filter.judge_urls(pages, URL_RULES).collect()))
    for common in (1, 50):
        monkeypatch.setattr(url_filter, "COMMON", common)
        monkeypatch.setattr(url_filter, "STRETCH", 5)
        assert sorted(map(tuple, url_filter.judge_urls(pages, URL_RULES).collect())) == want


def test_models_tell_accepted_from_rejected_urls(spark):
    """Accepted and rejected hosts differ by their paths only; the models carry that to hosts without a rule."""
    rng = random.Random(2)
    path = lambda good: "/".join(rng.choice(["guide", "manual", "notes"] if good else ["casino", "pills", "win"]) + str(rng.randint(1, 99)) for _ in range(2))
    rows = [(i, f"http://h{rng.randint(1, 40)}.{'com' if i % 2 else 'net'}/{'a/' if i % 2 else 'es/'}{path(i % 2)}") for i in range(300)]
    fresh = [(1000 + i, f"http://q{i}.org/{'a/' if i % 2 else 'es/'}{path(i % 2)}") for i in range(60)]
    pages = spark.createDataFrame(rows + fresh, "page_id long, url string")
    out = {r.page_id: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert all(out[i].rule is None and out[i].verdict == ("allow" if i % 2 else "block") for i, _ in fresh)


def test_urls_of_nothing_and_of_one_class(spark):
    pages = lambda *urls: spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert url_filter.judge_urls(pages(), URL_RULES).count() == 0
    assert [r.verdict for r in url_filter.judge_urls(pages(None, None), []).collect()] == ["allow", "allow"]
    out = url_filter.judge_urls(pages("http://a.com/1", "http://b.com/2", "http://c.org/3"), URL_RULES).collect()
    assert {r.host: r.rule for r in out} == {"a.com": "com/", "b.com": "com/", "c.org": None}
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages("x").withColumnRenamed("url", "path"), URL_RULES, "path")


# -- phrases ---------------------------------------------------------------------------------


def plain_phrases(rows, least=10, first=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in cand.items():
        lang, w = p[0], p[1:]
        longer = [b for q, b in cand.items() if q[0] == lang and len(q) > len(p) and any(q[i : i + len(w)] == w for i in range(1, len(q)))]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    ranks, got = Counter(), []
    for lang, s, a, w, l, r in sorted(out):  # noqa: E741
        ranks[lang] += 1
        if ranks[lang] <= first:
            got.append((lang, ranks[lang], w.decode(), -a, l, r, total[lang], -s))
    return got


def spoken(seed, n, words=30):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["the", "Of", "zu", "é", "中", "x-y", "don't"]) + str(i // 5) for i in range(words)]
    join = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "?", "\xa0", "\u2028"]
    return ["".join(w + rng.choice(join) for w in rng.choices(vocabulary, range(words, 0, -1), k=rng.randint(1, 120))) for _ in range(n)]


def counted(spark, rows, **how):
    docs = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], "doc_id long, lang string, text string, n int, phrase string")
    out = phrases.collocations(docs.repartition(3), **how).drop("k").collect()
    return sorted(map(tuple, out))


def test_phrases_against_brute_force(spark):
    texts = spoken(1, 260, 12)
    rows = [(["en", "de", None, "und"][i % 4], t) for i, t in enumerate(texts)]
    rows += [("en", None), ("en", ""), ("fr", " \t"), ("fr", "...!"), ("fr", "one"), ("fr", "a b c " * 40), (None, "A b, C " * 12), ("de", texts[1]), ("de", texts[1])]
    rows.append(("es", "long tail of " * 3000 + "y" * 100_000))
    want = plain_phrases(rows)
    assert counted(spark, rows) == sorted(want) and len(want) > 60
    assert counted(spark, rows, least=20, first=7) == sorted(plain_phrases(rows, 20, 7))


def test_phrases_of_nothing(spark):
    assert counted(spark, []) == []
    assert counted(spark, [("en", None), (None, "")]) == []


def leaves_of(runs, borders):
    """Counts of leaves from the packed blocks of runs, and the blocks by part."""
    got, parts = Counter(), defaultdict(list)
    for run in runs:
        assert (np.diff(run.keys) > 0).all()
        for row in run.blocks(borders):
            parts[row[0]].append(row)
            one = pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(row, phrases._BLOCK)], schema=phrases._BLOCK)
            table, names = phrases._loaded(row[3]), [None, *phrases._loaded(row[2]).column(0).to_pylist()]
            for *codes, n in zip(*[table.column(c).to_pylist() for c in ("w1", "w2", "w3", "n")]):
                leaf = tuple(names[c] for c in codes if c)
                assert sum(b <= (row[1], *leaf) for b in borders) == row[0]
                got[row[1], leaf] += n
            assert one.num_rows == 1
    return got, parts


def plain_leaves(rows):
    want = Counter()
    for lang, t in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)):
            w = re.findall("[^\x20\x09]+", piece)
            want.update((lang, tuple(w[j : j + 3])) for j in range(len(w)))
    return want


BORDERS = [("a", "don't0", "é1"), ("a", "of1"), ("b", "x"), ("c", "the2", "中0", "zu1"), ("c", "x-y"), ("und", "zu0")]


@pytest.mark.parametrize("most, burst", [(600_000, 4096), (600_000, 2), (60, 8), (1, 1)])
@pytest.mark.parametrize("borders", [[], BORDERS])
def test_trie_gives_whole_counts_however_often_it_bursts_and_spills(most, burst, borders, monkeypatch):
    monkeypatch.setattr(phrases, "AT_ONCE", 50)
    texts = spoken(3, 60, 15)
    batch = pa.record_batch({"lang": pa.array([["a", None, "c"][i % 3] for i in range(60)]), "text": pa.array(texts)})
    trie = phrases.Trie(most, burst)
    got, _ = leaves_of(list(phrases.sorted_runs([batch.slice(0, 25), batch.slice(25)], trie)), borders)
    assert got == plain_leaves([(["a", "und", "c"][i % 3], t) for i, t in enumerate(texts)])
    assert not trie.size and not trie.ids


def test_partitions_give_whole_counts_wherever_they_are_cut():
    texts = spoken(5, 80, 9)
    batch = pa.record_batch({"lang": pa.array(["a"] * 80), "text": pa.array(texts)})
    want, leaves = Counter(), plain_leaves([("a", t) for t in texts])
    for (_, leaf), n in leaves.items():
        for k in range(1, len(leaf) + 1):
            want[" ".join(leaf[:k])] += n
    every = sorted(("a", *leaf) for _, leaf in leaves)
    for borders in ([], every[::7], every, [("a", "of0"), ("a", "of0", "of0")]):
        _, parts = leaves_of(phrases.sorted_runs([batch.slice(0, 30), batch.slice(30)], phrases.Trie(50, 4)), borders)
        got = Counter()
        for rows in parts.values():
            table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), phrases._BLOCK)], schema=phrases._BLOCK)
            for r in phrases.merged(table, 4).to_pylist():
                got[r["phrase"]] += r["f"]
        whole = lambda c: {p: n for p, n in c.items() if n >= 4 or " " not in p}
        assert whole(got) == whole(want)


def test_a_task_with_very_many_words_starts_anew(monkeypatch):
    monkeypatch.setattr(phrases, "_WORD_MASK", 40)
    monkeypatch.setattr(phrases, "AT_ONCE", 20)
    text = " ".join(f"w{i % 97}" for i in range(1000))
    got, _ = leaves_of(phrases.sorted_runs([pa.record_batch({"lang": ["a"], "text": [text]})]), [])
    assert got == plain_leaves([("a", text)])


def test_phrases_over_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE_PLACES", 100)
    docs = spark.createDataFrame([("en", t) for t in spoken(1, 60, 12)], "lang string, text string")
    borders = phrases.range_borders(docs, 100)
    assert len(borders) > 10 and borders == sorted(set(borders))
    monkeypatch.setattr(phrases, "range_borders", lambda d: borders)
    rows = [(["en", None][i % 3 == 0], t) for i, t in enumerate(spoken(1, 200, 12))]
    assert counted(spark, rows) == sorted(plain_phrases(rows))


def test_merging_runs_holds_a_leaf_as_one_number():
    """Room that a partition takes while its runs are merged, by leaf."""
    import tracemalloc

    rng, runs, places = np.random.default_rng(5), 4, 50_000
    blocks = []
    for _ in range(runs):
        text = " ".join(f"w{i:06d}" for i in rng.integers(0, 2000, places).tolist())
        blocks += phrases.packed_runs([pa.record_batch([pa.array(["en"]), pa.array([text])], names=["lang", "text"])], [])
    table = pa.Table.from_batches(blocks, phrases._BLOCK)
    tracemalloc.start()
    try:
        got = phrases.merged(table, 10)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(f for p, f in zip(got["phrase"].to_pylist(), got["f"].to_pylist()) if " " not in p) == runs * places
    assert peak < 60 * runs * places


def test_merging_more_words_than_a_number_holds(monkeypatch):
    """Leaves of three numbers give the same counts."""
    texts = ["a b a b c", "b c a", "c a b a b"]
    blocks = list(phrases.packed_runs([pa.record_batch([pa.array(["x"] * 3), pa.array(texts)], names=["lang", "text"])], []))
    table = pa.Table.from_batches(blocks * 2, phrases._BLOCK)
    one = phrases.merged(table, 1).to_pylist()
    monkeypatch.setattr(phrases, "_REST", 0)
    assert phrases.merged(table, 1).to_pylist() == one
    assert {"lang": "x", "phrase": "a b", "f": 8} in one
