"""Operators for training data against brute force, on small fixtures with nulls, ties, repeats, empty and long texts and extra columns."""

import hashlib
import os
import random
import re

import numpy as np
import public_tokenizers
import pytest

from gridloom.llm import bpe, embedding_dedup, exact_dedup, jaccard, line_dedup, mixing, pii, quality, suffix_dedup, toxicity
from gridloom.llm.common import keep
from gridloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)
WORDS = [f"w{i}" for i in range(400)]


def text(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


BASE = text(200, 1)
NEAR = " ".join(["changed", *BASE.split()[1:]])
DOCS = [(1, BASE, "en", "b", 1), (2, BASE, "en", "a", 1), (3, NEAR, "en", "a", 1), (4, "", "en", None, 0), (5, None, None, None, None), (6, "one two", "en", "a", 1), (7, "one  two\n", "en", "b", 1), (8, text(3000, 2), "en", "a", 1), (9, "x\ny\nz\nx\ny\nz\nlast", "en", "a", 1), (10, "x\ny\nz\nend", "en", "b", 1), (None, "no id here", "en", "b", 1), (11, text(60, 9) + " " + text(90, 7), "en", "c", 1), (12, text(30, 8) + " " + text(90, 7), "en", "c", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    from pyspark.sql import functions as F

    # an extra column whose name is used inside
    return spark.createDataFrame(DOCS, SCHEMA).withColumn("digest", F.lit("x")).withColumn("tie", F.lit(1))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return {r[0]: r for r in df.collect()}


def test_exact_groups(docs, none):
    got = rows(exact_dedup.exact_groups(docs))
    assert len(got) == len(DOCS)
    assert got[1].keep_id == got[2].keep_id == 1 and got[2].group_size == 2 and not got[2].kept
    assert got[6].keep_id == 7 and got[7].kept  # more code points win
    assert got[4].keep_id == got[5].keep_id == 4
    assert got[6].text_sha256 == hashlib.sha256(b"onetwo").hexdigest()
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.exact_dedup(docs).columns == docs.columns


def test_line_dedup(docs, none):
    got = rows(line_dedup.line_dedup(docs))
    assert got[9].text == "x\ny\nz\nlast" and got[9].n_removed == 3
    assert got[10].text == "end" and got[5].text is None and got[4].text == "" and got[1].text == BASE
    assert line_dedup.line_dedup(none).count() == 0


def test_bpe_round_trip_and_stitching(docs, none, spark):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(4)
    control = "".join(r.choice(["a", "é", "1", " ", "\x1c", "\x85", "\n", "\u200b", "\u3000", "'s", "-", "\x00", "\U0001f600"]) for _ in range(90_000))
    digits = text(20_000, 6) + " " + "1234567890" * 12_000 + " " + text(20_000, 7)
    long = [(100, "é  x's\n\n" * 20_000), (101, "a" * 70_000), (102, " " * 40_000 + "b"), (103, text(30_000, 3)), (103, text(30_000, 3)), (104, control), (105, digits), (106, "日本語、" * 30_000), (107, "1" * 32_768), (108, "1" * 32_769), (109, "\n \n" * 30_000)]
    all_ = docs.select("doc_id", "text").unionByName(spark.createDataFrame(long, "doc_id long, text string"))
    out = bpe.encode(all_, path, public_tokenizers.PATTERN).collect()
    assert len(out) == len(DOCS) + len(long)
    want = {i: t or "" for i, t in [*((d[0], d[1]) for d in DOCS), *long]}
    for r in out:
        ids = e.encode_ordinary(want[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
    assert bpe.encode(none, path, public_tokenizers.PATTERN).count() == 0


def test_chunks_resynchronise():
    r = random.Random(9)
    for t in ("".join(r.choice("ab1 \n.'s-") for _ in range(6000)), text(1500, 5), "ab12" * 1500):
        whole = set(bpe.boundaries(t, public_tokenizers.PATTERN).tolist())
        for cut in range(1000, 4000, 7):
            before = bpe.boundaries(t[: cut + 300], public_tokenizers.PATTERN)
            after = bpe.boundaries(t[cut : cut + 2000], public_tokenizers.PATTERN) + cut
            at = bpe.agreement(before[before >= cut], after[after < cut + 300])
            assert at in whole  # found, and a boundary of the whole text
    assert bpe.agreement(np.arange(0, 300, 3), np.arange(1, 300, 3)) is None


def brute_components(sets, num, den):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and den * both >= num * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize(("k", "t"), [(3, (90, 100)), (5, (80, 100))])
def test_jaccard_against_all_pairs(spark, none, k, t):
    # a chain of near copies, each a few words further, and a bucket of unlike texts that share a passage
    made, words = [], text(150, 11).split()
    for i in range(60):
        words = list(words)
        for _ in range(1 + i % 3):
            words[rng.randrange(len(words))] = f"n{rng.random()}"
        made.append((i, " ".join(words)))
    made += [(100 + i, text(40 + i, 50 + i) + " " + text(30, 77)) for i in range(30)]
    made += [(200, BASE), (201, BASE), (202, ""), (203, None), (204, "One two"), (205, "one TWO"), (None, BASE)]
    got = jaccard.near_groups(spark.createDataFrame(made, "doc_id long, text string"), k, t).collect()
    sets = {}
    for i, s in made:
        w = re.findall(r"[^\x20\x09-\x0D]+", (s or "").lower())
        if i is not None:
            sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    want = brute_components(sets, *t)
    assert len(got) == len(made)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.component_id, r.n_shingles) == (want[r.doc_id], len(sets[r.doc_id]))
    assert jaccard.near_groups(none, k, t).count() == 0


def test_all_pairs_are_tried_where_the_nearest_were_refused(spark, monkeypatch):
    real = jaccard._in_blocks

    def nearest_tried(t, every):
        """In the first pass the nearest of each bucket are a pair that the star has tried: documents 1 and 2."""
        if every:
            return real(t, True)

        def blocks(batches):
            for df in batches:
                yield df[["token"]].drop_duplicates().assign(a=1, b=2)

        return blocks

    monkeypatch.setattr(jaccard, "_in_blocks", nearest_tried)
    made, want = [], {}
    for g in range(0, 80, 10):
        lead = text(100, 60 + g).split()
        changed = lambda at: " ".join({**dict(enumerate(lead)), **at}.values())  # noqa: B023, E731
        # 3 and 4 are near each other, too far from 1, and share its buckets
        made += [(g + 1, " ".join(lead)), (g + 2, changed({99: "last"})), (g + 3, changed({30: "x", 50: "y"})), (g + 4, changed({30: "x", 50: "z"}))]
        want |= {g + 1: g + 1, g + 2: g + 1, g + 3: g + 3, g + 4: g + 3}
    got = {r.doc_id: r.component_id for r in jaccard.near_groups(spark.createDataFrame(made, "doc_id long, text string"), 3, (90, 100)).collect()}
    assert got == want


@pytest.mark.parametrize(("chunk", "slab", "bundle"), [(65_536, 4, 2048), (40, 1, 16)])
def test_vectors_against_all_pairs(spark, monkeypatch, chunk, slab, bundle):
    for name, value in (("CHUNK", chunk), ("SLAB", slab), ("BUNDLE", bundle)):
        monkeypatch.setattr(embedding_dedup, name, value)
    g = np.random.default_rng(3)
    x = g.standard_normal((300, 64))
    x[100:200] = x[:100] + g.standard_normal((100, 64)) * 0.45
    x[200:230] = x[0]
    data = [(i, [float(f) for f in v]) for i, v in enumerate(x.astype(np.float32))]
    bad = [(900, None), (901, [0.0] * 64), (902, [float("nan")] + [1.0] * 63), (903, [None] + [1.0] * 63), (904, [1.0, 2.0]), (None, data[0][1])]
    got = embedding_dedup.vector_groups(spark.createDataFrame(data + bad, "vec_id long, embedding array<float>"), 0.9).collect()
    y = x.astype(np.float32).astype(float)
    u = y / np.sqrt((y * y).sum(1, keepdims=True))
    near = u @ u.T >= 0.9
    sets = {i: set(np.flatnonzero(near[i])) for i in range(300)}
    root = list(range(300))
    for _ in range(300):
        new = [min(root[j] for j in sets[i]) for i in range(300)]
        if new == root:
            break
        root = new
    for r in got:
        if r.vec_id is not None and r.vec_id < 300:
            assert (r.n_links, r.component_id, r.kept) == (len(sets[r.vec_id]) - 1, root[r.vec_id], root[r.vec_id] == r.vec_id)
        else:
            assert r.n_links == 0 and r.component_id == r.vec_id
    assert embedding_dedup.vector_groups(spark.createDataFrame([], "vec_id long, embedding array<float>"), 0.9).count() == 0


def test_components(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_components_of_few_edges_take_one_table(spark, monkeypatch):
    from gridloom.llm import components as module

    made, rng = [], random.Random(3)
    monkeypatch.setattr(module, "keep", lambda df: made.append(keep(df)) or made[-1])
    chain = [(i, i + 1) for i in range(300)] + [(400, 401), (7, 7), (500, 400), (400, 500)]
    rng.shuffle(chain)
    edges = spark.createDataFrame(chain, "a long, b long")
    want = {i: 0 for i in range(301)} | {400: 400, 401: 400, 500: 400}
    got = [tuple(r) for r in components(edges).collect()]
    assert len(made) == 1 and len(got) == len(want) and dict(got) == want
    monkeypatch.setattr(module, "EDGES", 20)  # so that runs of edges meet in stars
    monkeypatch.setattr(module, "release", lambda df: None)
    small_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = [tuple(r) for r in components(edges).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small_batch)
    assert len(made) > 3 and len(got) == len(want) and dict(got) == want


def test_repeated_passages(docs, none):
    got = suffix_dedup.repeated_passages(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.start_word, r.end_word, r.match_doc_ids))
    assert by[2] == [(0, 200, [1])]
    assert by[3][0][:2] == (1, 200)
    assert by[12] == [(30, 120, [11])] and 11 not in by and 8 not in by and 1 not in by
    assert suffix_dedup.repeated_passages(none).count() == 0


def test_passages_about_a_common_line_are_those_of_all_windows(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SALTED", 50)  # so that salts meet too
    made = []
    for k in range(3):
        line = text(46, 900 + k)
        for i in range(9):  # pairs that share 8 words besides the line, i of them before it
            for n in (0, 1):
                at = 1000 * k + 50 * n + i
                around = text(8, 100_000 + 1000 * k + i).split()
                made.append((at, " ".join([text(30, 200_000 + at), *around[:i], line, *around[i:], text(30, 300_000 + at)])))
        made += [(1000 * k + i, f"{text(30, 400_000 + 1000 * k + i)} {line} {text(30, 500_000 + 1000 * k + i)}") for i in range(100, 300)]
    random.Random(8).shuffle(made)
    want = repeated_by_windows(made)
    assert len(want) >= 27
    assert covered(spark, made) == want


def repeated_by_windows(made):
    """Words of each document in a window of 50 that stood somewhere before."""
    seen, want = {}, {}
    for i, t in sorted((i, t) for i, t in made if i is not None and t):
        w = t.split()
        for j in range(len(w) - 49):
            if seen.setdefault(tuple(w[j : j + 50]), (i, j)) != (i, j):
                want.setdefault(i, set()).update(range(j, j + 50))
    return want


def covered(spark, made):
    got = {}
    for x in suffix_dedup.repeated_passages(spark.createDataFrame(made, "doc_id long, text string")).collect():
        got.setdefault(x.doc_id, set()).update(range(x.start_word, x.end_word))
    return got


def test_passages_of_every_length_in_many_documents(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SALTED", 50)
    monkeypatch.setattr(suffix_dedup, "HOT", 100)  # some seeds are hot
    made = []
    for k, n in enumerate((50, 52, 55, 60, 65, 69)):
        passage = text(n, 700 + k)
        made += [(1000 * k + i, f"{text(i % 40, 10_000 * k + i)} {passage} {text(30, 20_000 * k + 90_000 + i)}") for i in range(100)]
    random.Random(1).shuffle(made)
    assert covered(spark, made) == repeated_by_windows(made)


def test_periodic_and_odd_texts(spark):
    r = random.Random(12)
    made = [(1, "a " * 400), (2, "b c " * 90), (3, text(70, 1) + " a" * 130 + " " + text(70, 2)), (4, "a " * 49 + text(40, 3)), (5, "c b " * 120), (6, " ".join(r.choice("xy") for _ in range(3000))), (7, ("p q r s t u v w " * 20) + text(60, 2)), (8, ("a b c d e f g h i j k l " * 30)), (9, None), (10, ""), (None, "a " * 100), (11, "d " * 51), (12, "d " * 50), (13, "x y x x " * 100), (14, text(70, 1) + " a" * 90 + " " + text(70, 2)), (15, text(30_000, 44) + " " + text(60, 2))]
    made += [(20, text(80, 5)), (20, text(80, 5))]  # one document twice
    want = repeated_by_windows([m for i, m in enumerate(made) if m not in made[:i]])
    assert covered(spark, made) == want


def test_mix(docs, none):
    got = mixing.mix(docs).collect()
    sizes = {}
    for _, t, _, s, _ in DOCS:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = sum(sizes.values())
    order = sorted([s for s in sizes if s is not None]) + [None]
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        level = (total - sum(target.values())) / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > 3 * sizes[s]}
        target |= {s: 3.0 * sizes[s] for s in full} if full else {s: level * w[s] for s in open_}
        open_ = open_ - full if full else set()
    src = {d[0]: d[3] for d in DOCS}
    for r in got:
        assert r.source_size == sizes[src[r.doc_id]] and abs(r.target - target[src[r.doc_id]]) < 1e-6
        assert r.taken <= 3 * r.size and r.taken == r.size * (r.epochs + r.picked)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    assert mixing.mix(none).count() == 0


def test_quality_and_toxicity_learn(spark, none):
    clean = [(i, text(80, i), None, "s", 1) for i in range(300)]
    junk = [(1000 + i, " | ".join("#" * 5 for _ in range(60)), None, "s", 1) for i in range(60)]
    toxic = [(2000 + i, text(60, 5000 + i) + " vile scum", None, "s", 1) for i in range(100)]
    extra = [(5000, None, None, None, None), (None, "", None, None, None)]
    all_ = spark.createDataFrame(clean + junk + toxic + extra, SCHEMA)
    labels = spark.createDataFrame([(d[0], int(d[0] < 1000 or d[0] >= 2000), int(d[0] >= 2000)) for d in clean + junk + toxic], "doc_id long, quality int, toxic int")
    got = rows(quality.classify(all_, labels))
    assert all(got[d[0]].accepted for d in clean + toxic) and not any(got[d[0]].accepted for d in junk)
    assert quality.accepted_documents(all_, labels).columns == all_.columns
    out = rows(toxicity.toxicity(all_, labels))
    held = [out[d[0]] for d in clean + toxic if out[d[0]].held_out]
    assert sum(r.predicted == (r.doc_id >= 2000) for r in held) >= 0.95 * len(held)
    assert 0 <= out[5000].score < 0.5 and len(out) == len(clean + junk + toxic + extra)
    assert quality.classify(none, labels).count() == 0 and toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(all_, labels.limit(0)).where("predicted = 1").count() == 0


def classified(made, told):
    """(id, weight, log odds, key, accepted) by counts, ratios, curve, noise and the k greatest keys, a document at a time."""
    import math
    import struct

    import xxhash

    grams = [quality.ngrams([(t or "").encode()])[0].tolist() for _, t in made]
    raw, good = [0] * quality.BUCKETS, [0] * quality.BUCKETS
    for (i, _), g in zip(made, grams, strict=True):
        for b in g:
            raw[b] += 1
            good[b] += told.get(i) == 1
    n_raw, n_good, n = sum(raw), sum(good), quality.BUCKETS
    prior = [(x + 1) / (n_raw + n) for x in raw]
    ratio = [math.log((g + 5 * n * p) / (n_good + 5 * n)) - math.log(p) for g, p in zip(good, prior, strict=True)]
    weight = [sum(ratio[b] for b in g) / (quality.FEW + len(g)) for g in grams]
    known = {}
    for (i, _), w in zip(made, weight, strict=True):
        if i in told:
            known.setdefault(i, []).append(w)
    b0, b1 = quality.curve(np.array([np.mean(known[i]) for i in sorted(known)]), np.array([float(told[i]) for i in sorted(known)]))

    def noise(i):
        h = xxhash.xxh64_intdigest(struct.pack("<i", 11), 42)
        h = h if i is None else xxhash.xxh64_intdigest(struct.pack("<q", i), h)
        return -math.log(-math.log((h % (1 << 40) + 0.5) / (1 << 40)))

    odds = [b0 + b1 * w for w in weight]
    keys = [o + noise(i) for (i, _), o in zip(made, odds, strict=True)]
    k = round(sum(1 / (1 + math.exp(-o)) for o in odds))
    at = sorted(keys, reverse=True)[k - 1]
    return [(i, w, o, x, x >= at) for (i, _), w, o, x in zip(made, weight, odds, keys, strict=True)]


def test_quality_against_plain_loops(spark):
    made = [(i, text(30 + i % 50, i)) for i in range(120)] + [(500 + i, "BUY NOW !!! " * (10 + i)) for i in range(40)] + [(900, None), (901, ""), (902, "?"), (None, text(20, 7)), (903, text(50, 1)), (903, "BUY NOW !!! "), (904, text(30_000, 5))]
    told = {**{i: 1 for i in range(0, 120, 2)}, **{500 + i: 0 for i in range(0, 40, 2)}}
    got = sorted((tuple(r) for r in quality.classify(spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame(list(told.items()), "doc_id long, quality int")).collect()), key=repr)
    want = sorted(classified(made, told), key=repr)
    assert [(r[0], r[4]) for r in got] == [(r[0], r[4]) for r in want]
    assert np.allclose([r[1:4] for r in got], [r[1:4] for r in want])


def test_quality_and_toxicity_on_rows_held_out(spark):
    """Labels of a fifth of the rows are hidden; the classifiers are judged by them."""
    from pyspark.sql import functions as F

    data = "/root/testdata/sf0.1"
    if not os.path.isdir(data):
        pytest.skip("no test tables here")
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    hidden = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    got = quality.classify(docs, labels.where(~hidden)).join(labels.where(hidden), "doc_id").collect()
    good, bad = [r.accepted for r in got if r.quality == 1], [r.accepted for r in got if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad) and len(good) > 50 and bad
    got = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got)


def test_exact_dedup_of_ids_with_several_texts(spark):
    from pyspark.sql import functions as F

    made = [(0, "other  text"), (1, "a b c"), (1, "other text"), (2, "a b c"), (3, "ab  c"), (3, "a b c "), (None, "n"), (None, "n "), (4, "z"), (4, "z"), (4, "z  ")]
    d = spark.createDataFrame(made, "doc_id long, text string").withColumn("_id", F.lit(1)).withColumn("_N", F.lit(1)).withColumn("_kept", F.lit(1)).withColumn("_digest", F.lit("d"))
    got = exact_dedup.exact_dedup(d)
    assert got.columns == d.columns
    assert sorted(((r[0], r[1]) for r in got.collect()), key=repr) == sorted([(0, "other  text"), (3, "a b c "), (None, "n "), (4, "z  ")], key=repr)
    assert jaccard.near_dedup(d).columns == d.columns
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.accepted_documents(d, labels).columns == d.columns


def test_segments_are_those_of_brute_force():
    for seed in range(200):
        r = np.random.default_rng(seed)
        s = r.integers(-4, 4, 14).astype(float)
        got = toxicity.segments(s)
        if (s > 0).any():
            best = max(s[a:b].sum() for a in range(14) for b in range(a + 1, 15))
            assert abs(max(x for _, _, x in got) - best) < 1e-9
        assert all(abs(s[a:b].sum() - x) < 1e-9 for a, b, x in got)
        assert all(b <= c for (_, b, _), (c, _, _) in zip(got[:-1], got[1:], strict=True))


def maximal_by_definition(s):
    """Ruzzo and Tompa: the greatest segment (the first, shortest of equals), then the same to its left and to its right."""
    best = None
    for a in range(len(s)):
        for b in range(a + 1, len(s) + 1):
            x = float(s[a:b].sum())
            if x > 0 and (best is None or x > best[2] + 1e-12 or abs(x - best[2]) <= 1e-12 and b - a < best[1] - best[0]):
                best = (a, b, x)
    if best is None:
        return []
    a, b, x = best
    return [*maximal_by_definition(s[:a]), best, *((b + p, b + q, y) for p, q, y in maximal_by_definition(s[b:]))]


def test_all_maximal_segments():
    r = np.random.default_rng(2)
    for _ in range(300):
        s = r.standard_normal(12)  # no ties
        got, want = toxicity.segments(s), maximal_by_definition(s)
        assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])


def test_extreme_value_parameters():
    score, p = np.array([1.0, -1.0]), np.array([0.3, 0.7])
    lam, k = toxicity.extreme_value(score, p)
    assert abs(lam - np.log(0.7 / 0.3)) < 1e-6 and 0 < k <= 0.5  # the known root for steps of one
    s = np.array([1.0] * 12 + [-1.0] * 40 + [1.0] * 12)
    assert toxicity.passages(s, lam, k) == [(0, 12), (52, 64)]  # the same passage twice is found twice


def plain_by_regex(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m.group())) <= 15]
    return [(s, pii.KINDS[k], e) for s, k, e in sorted(out)]


def test_plain_pii_is_that_of_the_patterns():
    r = random.Random(2)
    for _ in range(20_000):
        t = "".join(r.choice("a.@1-+ 2(3") for _ in range(r.randint(0, 40)))
        assert pii.plain(t) == plain_by_regex(t)


@pytest.mark.parametrize(("t", "kind", "found"), [("to john.doe (at) mail [dot] example [dot] com ok", "email", "john.doe (at) mail [dot] example [dot] com"), ("mail bob at example dot com", "email", "bob at example dot com"), ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"), ("１０.２０.３０.４０", "ip", "１０.２０.３０.４０"), ("call plus one two three four five six seven eight nine zero", "phone", "plus one two three four five six seven eight nine zero")])
def test_disguises_map_back(t, kind, found):
    _, more = pii.spans(t)
    assert (kind, found) in [(k, t[a:b]) for a, k, b in more]


@pytest.mark.parametrize(("t", "kind"), [("+1 202 555 01 two three", "phone"), ("+1 two 0 two 5 five 5 zero 1 four 2", "phone"), ("+1 202 555 one two three", "phone"), ("+௧ ௨௦௨ ௫௫௫ ௦௧௨௩", "phone"), ("૧૦.૨૦.૩૦.૪૦", "ip"), ("+១ ២០២ ៥៥៥ ០១២៣", "phone"), ("bob@mail . com", "email")])
def test_no_gate_before_the_transducers(t, kind):
    base, more = pii.spans(f"call {t}")
    assert (kind, 5, 5 + len(t)) in [(k, a, b) for a, k, b in base + more]


def test_prose_is_left_alone():
    for t in ("look at example.com", "un deux trois", "one of the six at nine", "see you at 10", None, ""):
        assert pii.spans(t) == ([], [])


def test_find_pii(docs, none):
    assert pii.find_pii(docs).count() == len(DOCS) and pii.find_pii(none).count() == 0


def mixed(made, weight):
    """How often each document of (id, text, source) is taken: targets by water level, then keys in order while they fit, then what fits best."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = {}
    for i, t, s in made:
        u = (int(hashlib.md5(f"mix:{'null' if i is None else i}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        by.setdefault(s, []).append((1 - u ** (1 / weight.get(i, 1.0)), i, words(t)))
    order = [*sorted(s for s in by if s is not None), *[s for s in by if s is None]]
    size, w = {s: sum(r[2] for r in by[s]) for s in order}, {s: j % 3 + 1 for j, s in enumerate(order)}
    target, left = {}, set(order)
    while left:
        level = (sum(size.values()) - sum(target.values())) / sum(w[s] for s in left)
        full = {s for s in left if level * w[s] > 3 * size[s]}
        target |= {s: 3 * size[s] for s in full} if full else {s: level * w[s] for s in left}
        left = left - full if full else set()
    taken = {}
    for s, docs in by.items():
        whole = int(target[s] // size[s]) if size[s] else 0
        need, upto, picked = target[s] - whole * size[s], 0, set()
        for key, i, n in sorted(docs):
            upto += n
            if need > 0 and upto <= need:
                picked.add(i)
        rest = need - sum(n for _, i, n in docs if i in picked)
        for _ in range(3):
            free = [(abs(n - rest), key, i, n) for key, i, n in docs if n and i not in picked and abs(n - rest) < rest]
            if not free:
                break
            _, _, i, n = min(free)
            picked.add(i)
            rest -= n
        for _, i, n in docs:
            taken[i] = (whole + (i in picked), n, target[s])
    return taken


def test_mix_with_quality_weights(spark):
    from pyspark.sql import functions as F

    r = random.Random(3)
    made = [(i, text(r.choice([0, 1, 5, 40, 300]), i), r.choice(["a", "b", "c", "d", None])) for i in range(300)] + [(400, None, "a"), (401, text(20_000, 1), "b"), (402, text(4, 4), "lone")]
    weight = {i: 2.0 if i % 3 else 0.5 for i in range(0, 300, 2)}
    docs = spark.createDataFrame(made, "doc_id long, text string, source string").withColumn("_s", F.lit(1)).withColumn("bin", F.lit(1)).withColumn("weight", F.lit(9.0)).withColumn("key", F.lit(0))
    got = mixing.mix(docs, spark.createDataFrame(list(weight.items()), "doc_id long, weight double")).collect()
    want = mixed(made, weight)
    assert {r.doc_id: r.taken for r in got} == {i: n * size for i, (n, size, _) in want.items()} and len(got) == len(made)
    assert all(abs(r.target - want[r.doc_id][2]) < 1e-6 for r in got)
    twice = mixing.mix(spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (1, "c", "s"), (2, "a b c", "t")], "doc_id long, text string, source string")).collect()
    assert len(twice) == 4 and all(r.taken <= 3 * r.size for r in twice)


def test_pipeline_against_brute_force(spark, none, tmp_path):
    """All five stages over a table with nulls, empty and very long texts, copies, near copies, ties, repeated rows and columns of clashing names."""
    import base64

    import corpus_pipeline
    import tiktoken
    from pyspark.sql import functions as F

    base = [text(120, 3000 + i) for i in range(12)]
    rows_ = [(i, text(60 + i % 40, i), f"s{i % 4}") for i in range(100)]
    rows_ += [(200 + i, base[i % 12], "s1") for i in range(30)]  # copies
    rows_ += [(300 + i, " ".join(["x", *base[i].split()[1:]]), "s2") for i in range(12)]  # near copies
    rows_ += [(400 + i, "BUY NOW !!! $$$ " * (5 + i), "spam") for i in range(30)]
    rows_ += [(500, None, "s1"), (501, "", None), (502, text(40_000, 9), "s3"), (503, "a", None), (504, base[0].replace(" ", "  "), "s3"), (505, text(90, 6), "s3"), (505, text(90, 6), "s3")]
    told = {**{i: 1 for i in range(0, 100, 2)}, **{400 + i: 0 for i in range(0, 30, 2)}, **{200: 1, 502: 1}}
    d = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows_], SCHEMA)
    for name in ("_id", "_n", "_copy", "digest", "keep"):
        d = d.withColumn(name, F.lit(7))
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, q, 0) for i, q in told.items()], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    fine = {(i, t, s) for (i, t, s), (_, _, _, _, ok) in zip(rows_, classified([(i, t) for i, t, _ in rows_], told), strict=True) if ok}
    assert 0 < len(fine) < len(rows_)
    best = {}
    for i, t, s in fine:
        k = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[k] = min(best.get(k, (1, 0, None, None)), (-len(t or ""), i, t, s))
    once = {i: (t, s) for _, i, t, s in best.values()}
    sets = {}
    for i, (t, _) in once.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    first = brute_components(sets, 80, 100)
    apart = {i: x for i, x in once.items() if first[i] == i}
    assert len(apart) < len(once) < len(fine)
    taken = mixed([(i, t, s) for i, (t, s) in apart.items()], {i: 2.0 if q else 0.5 for i, q in told.items()})
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, (n, _, _) in taken.items():
        ids = np.array(e.encode_ordinary(apart[i][0] or ""), "<u4")
        want += [(i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), ids.tobytes())] * n
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, bytes(r.ids)) for r in got) == sorted(want)
    none.write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "empty" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cols, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    n = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.columns == cols, name
        n.append(docs.count())
        if len(n) == 2:
            kept = {r.doc_id for r in docs.collect()}
            good = [i for i, q in labels.items() if q == 1]
            assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert n[0] >= n[1] >= n[2] >= n[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert out.count() == n[4]


EDGES = [(1, "one two three four five six", "en", "a", 1), (1, "one two three four five six", "en", "a", 1), (1, "another text under the same id", "en", "b", 1), (2, None, None, None, None), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \t\n", "en", "a", 3), (None, "no id", "en", "b", 1), (None, None, None, None, None), (5, "word " * 300_000, "en", "c", 1), (6, "x" * 500_000, "en", "c", 1), (7, "mail a@b.co or +1 202 555 0123\n" * 20_000, "en", "c", 1)]


def test_every_operator_with_repeats_nulls_long_texts_and_clashing_names(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame(EDGES, SCHEMA)
    for name in ("_d", "_t", "tie", "gone", "ls", "runs", "row", "key", "score", "toxic", "quality", "weight", "digest", "cid", "node", "component", "n", "bucket", "spans", "id", "seed"):
        d = d.withColumn(name, F.lit("x"))
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, 0, 1), (7, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    made = {
        "lines": line_dedup.line_dedup(d), "quality": quality.classify(d, labels), "bpe": bpe.encode(d, path, public_tokenizers.PATTERN),
        "toxicity": toxicity.toxicity(d, labels), "pii": pii.find_pii(d), "exact": exact_dedup.exact_groups(d), "near": jaccard.near_groups(d, 5, (80, 100)), "mix": mixing.mix(d),
    }
    for name, out in made.items():
        got = out.collect()
        assert sorted(repr(r.doc_id) for r in got) == sorted(repr(e[0]) for e in EDGES), name
    lines = {(r.doc_id, r.text) for r in made["lines"].collect()}
    # every later window of the line is gone; the empty line behind the last one is in no repeated window
    assert (7, "mail a@b.co or +1 202 555 0123\n") in lines
    found = {r.doc_id: (r.n_email, r.n_phone, r.n_spans) for r in made["pii"].where("doc_id = 7").collect()}
    assert found == {7: (20_000, 20_000, 40_000)}
    near = [r.component_id for r in made["near"].where("doc_id = 1").collect()]
    assert near == [1, 1, 1]
    spans = {(r.doc_id, r.start_word, r.end_word) for r in suffix_dedup.repeated_passages(d).collect()}
    assert (5, 1, 300_000) in spans
    v = spark.createDataFrame([(1, [1.0, 0.0], "x"), (1, [1.0, 0.0], "y"), (2, [2.0, 0.0], "z"), (3, [0.0, -0.0], "z"), (4, [], "z"), (5, [1e300, 1e-300], "z"), (6, [0.0, 1.0], "z")], "vec_id long, embedding array<double>, cid string").withColumn("mult", F.lit(1)).withColumn("k1", F.lit(1)).withColumn("a", F.lit(1))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.vector_groups(v, 0.9).collect())
    assert got == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 3, 1), (6, 0, 6)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_embedding_dedup", "op7_exact_dedup", "op9_ngram_jaccard", "op10_mixing"])
def test_registered_queries_match_their_sql(spark, name):
    import duckdb

    from gridloom.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = queries.queries()[name](spark, sf)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall()
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    assert sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=repr) == sorted((tuple(map(plain, r)) for r in want), key=repr)
