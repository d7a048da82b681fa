"""Each operator on nulls, empty and long texts, repeats, clashing columns and empty tables."""

import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelflens.llm import bpe, bpe_stream, exact_dedup, langid, mixing, repeats, simhash, threshold_topk
from shelflens.llm import token_count, toxicity, url_filter

PATH = public_tokenizers.path("byte_bpe_50k.json")
LONG = "the quick brown fox jumps over the lazy dog and runs away from all of them at once " * 300
TEXTS = [
    (1, "a plain text with some words in it, and enough of them to be more than fifty bytes", "en", "a"),
    (2, None, None, None), (3, "", "en", "b"), (4, LONG, "en", "a"), (5, LONG, "en", "b"),
    (6, " \n\t ", "de", "a"), (7, "x" * 3000 + " 'll <|endoftext|> é中", "fr", "c"), (7, "again", "fr", "c"),
    (8, "a plain text with some words in it, and enough of them to be more than fifty bytes!", None, "a"),
    (9, "123 456", "en", "c"), (None, "no id", "en", "a"), (10, "no id", "en", "a"), (10, "no id", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    """Columns that operators use inside are there as well, and are ignored."""
    plain = spark.createDataFrame(TEXTS, SCHEMA)
    return plain.withColumns({c: F.lit("clash") for c in ("_id", "_run", "size", "fp", "block", "score", "_row")})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(open(PATH, "rb").read())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_dedup(docs, nothing):
    got = exact_dedup.mark_copies(docs).collect()
    want = {}
    for i, t, *_ in TEXTS:
        want.setdefault(t or "", []).append(i)
    assert len(got) == len(TEXTS)
    for r in got:
        group = next(g for t, g in want.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(group) and r.keep_id == max(i for i in group if i is not None)
    assert sum(r.kept for r in got) == len(want)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(want)
    assert exact_dedup.mark_copies(nothing).count() == exact_dedup.drop_copies(nothing).count() == 0


@pytest.mark.parametrize(("runs", "fan_in"), [(1, 2), (7, 2), (16, 4), (256, 16)])
def test_exact_dedup_merges_sorted_runs(spark, runs, fan_in):
    texts = [f"text {i % 11 if i % 3 else 0}" if i % 7 else None for i in range(400)]
    frame = spark.createDataFrame([(i * 37 % 400, t) for i, t in enumerate(texts)], "doc_id long, text string")
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t, []).append(i * 37 % 400)
    want = sorted((i, max(g), len(g), i == max(g)) for g in groups.values() for i in g)
    marked = exact_dedup.mark_copies(frame, runs=runs, fan_in=fan_in)
    assert sorted(tuple(r)[:4] for r in marked.collect()) == want
    kept = exact_dedup.drop_copies(frame, runs=runs, fan_in=fan_in)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(map(max, groups.values()))
    for plan in (marked, kept):
        steps = plan._jdf.queryExecution().sparkPlan().toString()
        assert "Aggregate" not in steps and "Window" in steps


def test_mixing(docs, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    assert total == sum(len((t or "").split()) for _, t, *_ in TEXTS)
    targets = {r.source_size: r.target for r in got}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    assert abs(sum(r.taken for r in got) - 1.5 * total) <= 4
    assert rows(mixing.mix(docs)) == rows(mixing.mix(docs.repartition(5)))
    assert mixing.mix(nothing).count() == mixing.mixed_documents(nothing).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_tokens(docs, nothing):
    tok = Tokenizer.from_file(PATH)
    coded = [tok.encode(t or "", add_special_tokens=False).ids for _, t, *_ in TEXTS]
    want = sorted(((i, len((t or "").encode()), len(c), len(c) > 1024) for (i, t, *_), c in zip(TEXTS, coded)), key=repr)
    assert rows(token_count.count_tokens(docs, PATH)) == want

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = sorted(
        ((t[0], len(c), sha(",".join(map(str, c))), sha(tok.decode(c, skip_special_tokens=False))) for t, c in zip(TEXTS, coded)),
        key=repr,
    )
    assert rows(bpe_stream.round_trip(docs, PATH)) == want
    back = bpe_stream.decoded(bpe_stream.encoded(docs, PATH), PATH)
    assert rows(back) == sorted(((i, t or "") for i, t, *_ in TEXTS), key=repr)
    assert token_count.count_tokens(nothing, PATH).count() == bpe_stream.round_trip(nothing, PATH).count() == 0


PIECES = st.sampled_from(["a", "'", "s", " ", "\n", "1", "é", "中", "!", "<|endoftext|>", "re", " the", "=" * 700, "b" * 600, " " * 650])


@settings(max_examples=60, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join), st.sampled_from([1, 7, 64, 700]))
def test_streams_equal_the_library(text, piece):
    vocab = bpe.vocabulary(open(PATH, "rb").read())
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    coder, got = bpe_stream.Coder(vocab), []
    for part, special in vocab.parts(text):
        pieces = [part[i : i + piece] for i in range(0, len(part), piece)]
        stretches = [[coder.known([vocab.special[part]])]] if special else coder.encode(pieces)
        got += [int(i) for s in stretches for ids, _ in s for i in ids.split(",")]
    assert got == want and token_count.Counts(vocab).of(text) == len(want)
    decoder = bpe_stream.Decoder(vocab)
    assert "".join(decoder.feed([i]) for i in want) + decoder.finish() == text


def test_lookahead_is_enough(vocab):
    ahead = bpe_stream.lookahead(vocab)
    rng = np.random.default_rng(3)
    for _ in range(30):
        word = "".join(rng.choice(list("abeinrst=-"), 2500))
        machine = bpe_stream.Transducer(vocab, ahead)
        got = [t for s in vocab.ids(word) for t in machine.feed([s])] + machine.finish()
        assert got == bpe_stream.merged(vocab.ids(word), vocab) and ahead < 1000


def test_topk(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    data += [(300, None), (350, [1.0, None]), (400, [float("nan")] * 8), (None, [1.0] * 8), (50, [0.5] * 8), (450, [1.0]), (451, [2.0])]
    data += [(500, []), (501, [])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("rid", F.lit(1))
    good = [(n, i, [int(np.floor(256 * x)) for x in v]) for n, (i, v) in enumerate(data)
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for n, i, v in good:
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in good if m != n and len(w) == len(v))
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:5])]
    assert rows(threshold_topk.top_k(frame)) == sorted(want, key=repr)
    assert threshold_topk.top_k(frame.limit(0)).count() == 0


def test_simhash(docs, nothing):
    got = simhash.near_groups(docs).collect()
    prints = [(i, simhash.fingerprint(t)) for i, t, *_ in TEXTS]
    root = list(range(len(prints)))
    for _ in prints:
        for a, (_, x) in enumerate(prints):
            for b, (_, y) in enumerate(prints):
                if (x ^ y).bit_count() <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    least = {}
    for r, (i, _) in zip(root, prints):
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (least.get(r), i) != (None, None) else None
    want = sorted(((i, f"{p:016x}", least[r]) for r, (i, p) in zip(root, prints)), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert simhash.keep_one(docs).count() == len(set(root))
    assert simhash.near_groups(nothing).count() == simhash.keep_one(nothing).count() == 0


def tile_sizes(fps, parts):
    codes = simhash.code_of(simhash.tile_counts(fps, parts), parts)
    return np.bincount(codes, minlength=int(np.prod([n + 1 for _, n in parts])))


@pytest.mark.parametrize(("n", "cell"), [(3, 1 << 14), (3, 5), (4, 7), (5, 3), (6, 1 << 14)])
def test_simhash_tiles_lose_no_pair(monkeypatch, n, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, k, False))) for b in base for k in range(6)]
    fps = np.unique(np.concatenate([base, np.array(flips, np.uint64)]))
    parts = simhash.parts_of(n)
    plan, met, buckets = simhash.Plan(tile_sizes(fps, parts), 3, parts), {}, {}
    for cells, tiles, at, home in plan.cells(fps):
        for c, b, i, h in zip(cells.tolist(), plan.bucket(cells, tiles).tolist(), at.tolist(), home.tolist()):
            met.setdefault(c, ([], []))[0 if h else 1].append(i)
            assert buckets.setdefault(c, b) == b
    seen = {(min(a, b), max(a, b)) for rs, vs in met.values() for a in rs for b in vs}
    near = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if int(fps[a] ^ fps[b]).bit_count() <= 3}
    assert near and near <= seen and len(seen) < len(fps) ** 2 / 4
    assert [buckets[c] for c in sorted(buckets)] == sorted(buckets.values())


@pytest.mark.parametrize(("rows", "copies", "share"), [(10**6, 70, 0.05), (3 * 10**7, 200, 0.01), (10**8, 220, 0.01)])
def test_simhash_sends_few_copies_of_a_row(rows, copies, share):
    """The plan alone, for random fingerprints: copies of each, and pairs compared of all."""
    parts = simhash.parts_for(rows)
    chance = np.ones(1)
    for _, n in parts:
        chance = np.multiply.outer(chance, [math.comb(n, k) / 2**n for k in range(n + 1)]).reshape(-1)
    plan = simhash.Plan(np.round(chance * rows).astype(np.int64), 3, parts)
    cells = plan.rows * plan.columns
    compared = int((np.maximum(plan.work, 0) * cells).sum())
    assert compared < share * rows * rows / 2
    some = np.random.default_rng(3).integers(0, 1 << 64, 20_000, np.uint64)
    assert sum(len(c) for c, *_ in plan.cells(some)) < copies * len(some)
    assert sum(v.nbytes for v in vars(plan).values() if isinstance(v, np.ndarray)) < 110e6


def test_repeats(docs, nothing):
    first = {}
    for i, t, *_ in TEXTS:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], 1 << 62), 1 << 61 if i is None else i)
    want = []
    for i, t, *_ in TEXTS:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (1 << 61 if i is None else i):
                gone[p : p + 50] = b"\1" * 50
        left = bytes(x for x, y in zip(b, gone) if not y)
        want.append((i, len(b), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x), hashlib.sha256(left).hexdigest()))
    for block_bytes in (1 << 20, 9_000):
        assert rows(repeats.remove_repeats(docs, block_bytes=block_bytes)) == sorted(want, key=repr)
    assert repeats.remove_repeats(nothing).count() == 0


def test_topk_ties_and_numbers_beyond_32_bits(spark):
    """Candidates that tie go by id, copies of the query's own vector too; large numbers stay exact."""
    data = [(i, [float(i % 3), 1.0]) for i in range(1, 61)] + [(50, [2.0, 1.0]), (100, [0.0, 1.0])]
    for scale in (1.0, 2.0**26):
        frame = spark.createDataFrame([(i, [x * scale for x in v]) for i, v in data], "vec_id long, embedding array<double>")
        factor = int(256 * scale)
        want = []
        for n, (i, v) in enumerate(data):
            if i % 50 == 0:
                found = sorted((-sum(int(a) * int(b) * factor**2 for a, b in zip(v, w)), j) for m, (j, w) in enumerate(data) if m != n)
                want += [(i, r + 1, j, max(-(1 << 63), min(-s, (1 << 63) - 1))) for r, (s, j) in enumerate(found[:5])]
        assert rows(threshold_topk.top_k(frame)) == sorted(want, key=repr)


def test_topk_copies_of_a_row_stay_few():
    """Rows sent per row at 10 M vectors of 64 components: a few, not one per thousand rows."""
    asked, held = 200_000, 10_000_000
    q_blocks, c_blocks = threshold_topk.blocks(asked, held, 64, 4, 6)
    assert q_blocks <= 8 and c_blocks <= 160
    assert held * q_blocks + asked * c_blocks < 12 * held
    # Small tables still give every task something, empty ones one block.
    assert threshold_topk.blocks(1_000, 50_000, 64, 4, 12) == (1, 12)
    assert threshold_topk.blocks(0, 0, 0, 4, 12) == (1, 1)


def test_url_trees_on_held_out_urls(spark):
    """Labelled urls that the trees were not fitted on: at least nine in ten as the rules say."""
    hosts = ["a.net", "shop.net", "example.net", "b.example.net", "example.com", "w.example.com", "x.org", "y.org"]
    urls = [(i, f"http://{hosts[i % 8]}/{('en', 'de', 'fr')[i // 8 % 3]}/{i * 37 % 1009}") for i in range(1200)]
    frame = spark.createDataFrame(urls, "page_id long, url string")
    order = [r.page_id for r in frame.orderBy(F.xxhash64("page_id")).collect()]
    got = {r.page_id: r for r in url_filter.judge(frame, training_rows=300).collect()}
    labelled = [i for i in order if got[i].rule is not None]
    held_out = labelled[300:]
    right = sum((got[i].score > 0.5) == (got[i].verdict == "block") for i in held_out)
    assert len(held_out) > 200 and right >= 0.9 * len(held_out)


def test_url_suffix_statistics_leave_the_own_label_out(spark):
    """A row with a suffix of its own learns nothing from itself; salted and broadcast agree."""
    rows_ = spark.createDataFrame(
        [(i, "/", 1.0, "com" if i % 3 else f"s{i}") for i in range(60)], "page_id long, path string, f_entropy double, _suffix string"
    )
    counts = rows_.groupBy("_suffix").agg(F.count("page_id").alias("_n"))
    near = rows(url_filter.with_statistics(rows_, counts).select("page_id", "_n"))
    assert near == rows(url_filter.with_statistics(rows_, counts, most=3).select("page_id", "_n"))
    assert len(near) == 60


def test_url_filter(spark):
    urls = [
        (1, "http://A.NET/x"), (2, "http://net/"), (3, "http://b.example.net/en/q?x=1"), (4, "http://example.net/enx"),
        (5, "https://example.com/de/1"), (6, "http://x.org/fr/2#a"), (7, "http://x.org/de/2"), (8, None), (9, ""), (10, "no scheme"),
        (11, "http://a.net"), (11, "http://a.net"), (12, "http://" + "y" * 50_000 + ".org/fr/"),
    ]
    frame = spark.createDataFrame(urls, "page_id long, url string").withColumn("label", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.judge(frame).collect()}
    rule = {i: r.rule for i, r in got.items()}
    assert rule == {1: "net/", 2: "net/", 3: "example.net/en/", 4: "net/", 5: "example.com/de/", 6: "org/fr/", 7: None,
                    8: None, 9: None, 10: None, 11: None, 12: "org/fr/"}
    assert (got[1].host, got[1].path, got[11].path, got[8].host) == ("a.net", "/x", "", "")
    assert {r.verdict for r in got.values()} <= {"allow", "block"} and got[1].verdict == "block"
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_language_and_toxicity_edges(spark, docs, nothing):
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(docs).collect()}
    assert {(2, "und"), (3, "und"), (6, "und"), (9, "und")} <= found
    assert langid.identify(nothing).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(nothing)).collect()} == {"und"}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.judge(docs, none).collect()
    assert len(got) == len(TEXTS) and all(r.predicted == 0 for r in got)
    assert toxicity.judge(nothing, none).count() == 0
    assert toxicity.drop_toxic(docs, none).columns == docs.columns


def test_compressed_chain_has_exact_marginals():
    rng = np.random.default_rng(4)
    model = toxicity.Field({"bad": 3.0, "worse": 5.0}, -2.0, np.array([[0.4, -0.5], [-0.2, 0.3]]))
    for _ in range(20):
        words = rng.choice(["a", "b", "bad", "worse"], 30, p=[0.5, 0.3, 0.1, 0.1]).tolist()
        emit = np.array([[1.0, np.exp(model.bias + model.words.get(w, 0.0))] for w in words])
        go, ahead, back = np.exp(model.moves), [emit[0]], [np.ones(2)]
        for e in emit[1:]:
            ahead.append((ahead[-1] @ go) * e)
        for e in emit[:0:-1]:
            back.append(go @ (back[-1] * e))
        both = np.array(ahead) * np.array(back[::-1])
        exact = both[:, 1] / both.sum(1)
        places = [i for i, w in enumerate(words) if w in model.words]
        got = model.marginals(places, [model.words[words[i]] for i in places], len(words))
        assert np.allclose(got, exact[places])


def test_learned_operators_hold_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    right = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    judged = toxicity.judge(docs, labels).join(labels, "doc_id").filter("held_out")
    clean, toxic = (judged.filter(F.col("toxic") == t).agg(F.avg("predicted")).first()[0] for t in (0, 1))
    assert clean < 0.05 and toxic > 0.5


def test_sample_shuffles_few_rows_of_a_label(spark):
    from shelflens.llm.common import hash_order, smallest_hashes

    lang = F.when(F.col("id") % 10 == 0, "de").otherwise("en")
    rows = spark.range(20_000).select(lang.alias("lang"), hash_order("id").alias("_order"))
    chosen = smallest_hashes(rows, "lang", "_order", 100)
    want = sorted(x for name in ("de", "en") for x in sorted(r._order for r in rows.collect() if r.lang == name)[:100])
    assert sorted(r._order for r in chosen.collect()) == want
    plan = chosen._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_too_many_labels_raise(spark):
    from shelflens.llm.common import hash_order, smallest_hashes

    rows = spark.range(40).select(F.col("id").cast("string").alias("lang"), hash_order("id").alias("_order"))
    assert smallest_hashes(rows, "lang", "_order", 5, labels=40).count() == 40
    with pytest.raises(ValueError, match="40 different labels"):
        smallest_hashes(rows, "lang", "_order", 5, labels=39)


def test_mixed_documents_take_each_row_as_the_mix_does(spark):
    """Every row of a source repeats one id, or has none: the mix still adds up to the targets."""
    text = F.concat(F.repeat(F.lit("word "), (F.col("id") % 7).cast("int") + 1), F.col("id").cast("string"))
    twins = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id")).alias("doc_id"),
        text.alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("source"),
        F.lit("clash").alias("_key"), F.lit("clash").alias("_row"), F.lit("clash").alias("_source"), F.lit("clash").alias("_tie"),
    )
    sizes = mixing.mix(twins)
    goals = {(r.source_size, r.target) for r in sizes.collect()}
    assert sizes.agg(F.sum("taken")).first()[0] >= sum(int(t) for _, t in goals) - 4
    mixed = mixing.mixed_documents(twins)
    assert mixed.columns == twins.columns
    got = mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    want = twins.withColumn("size", mixing.word_count(F.col("text"))).groupBy("source").agg(F.sum("size").alias("n")).collect()
    by_size = {size: target for size, target in goals}
    assert len(got) == 4
    for r in got:
        size = next(x.n for x in want if x.source == r.source)
        # The document that the cut runs through comes whole or not at all.
        assert abs(r.n - by_size[size]) <= 8
    copies = mixed.groupBy("text").count().agg(F.max("count")).first()[0]
    assert copies <= 2
    assert rows(mixed) == rows(mixing.mixed_documents(twins.repartition(7)))


def plain_field(model, words):
    """Marginals of the field by forward-backward over every word."""
    emit = np.array([[1.0, np.exp(model.bias + model.words.get(w, 0.0))] for w in words])
    go, ahead, back = np.exp(model.moves), [emit[0] / emit[0].sum()], [np.ones(2)]
    for e in emit[1:]:
        step = (ahead[-1] @ go) * e
        ahead.append(step / step.sum())
    for e in emit[:0:-1]:
        step = go @ (back[-1] * e)
        back.append(step / step.sum())
    both = np.array(ahead) * np.array(back[::-1])
    return both[:, 1] / both.sum(1)


def test_marginals_with_negative_weights():
    rng = np.random.default_rng(8)
    model = toxicity.Field({"bad": 4.0, "kind": -3.0, "fair": -0.5}, -1.0, np.array([[0.2, -0.4], [-0.3, 0.6]]))
    for n in (1, 2, 40, 400):
        words = rng.choice(["a", "bad", "kind", "fair"], n).tolist()
        places = [i for i, w in enumerate(words) if w in model.words]
        got = model.marginals(places, [model.words[words[i]] for i in places], n)
        assert np.allclose(got, plain_field(model, words)[places])


def test_training_keeps_every_weight():
    """A word that leans to toxic documents for other reasons gets a weight below nought and keeps it."""
    rng = np.random.default_rng(1)
    usual = [f"w{i}" for i in range(200)]
    sample = []
    for i in range(600):
        words = rng.choice(usual, 40).tolist()
        if i % 3 == 0:
            words += ["insult", "insult"] + ["beside"] * int(rng.integers(1, 4))
        elif i % 7 == 0:
            words += ["beside"]
        sample.append((words, int(i % 3 == 0)))
    leaning, toxic = toxicity.telling_words(sample)
    model = toxicity.train_chains(sample)
    assert set(model.words) == leaning and "insult" in toxic
    assert model.words["insult"] > 0


def test_spans_on_whole_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs.filter(toxicity.learnable()), labels)
    judged = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    spans = 0
    for doc in docs.collect():
        text, found = doc.text or "", judged[doc.doc_id]
        words = toxicity.words_of(text)
        chances = plain_field(model, words) if words else []
        known = [i for i, w in enumerate(words) if w in model.words]
        places = [m.span() for m in toxicity.WORD.finditer(text)]
        covered = {(s.start, s.end) for s in found.spans}
        flat = [i for i in known if chances[i] >= 0.5]
        assert {i for i, (a, b) in enumerate(places) if any(s <= a and b <= e for s, e in covered)} == set(flat)
        assert abs(found.score - model.score(sum(chances[i] for i in known))) < 1e-6
        spans += len(covered)
    assert spans > 10


def test_long_labelled_texts_are_learned_from(spark):
    text = "".join(chr(ord("a") + i % 26) for i in range(9000))
    frame = spark.createDataFrame([(1, text), (2, "short"), (3, "é" * 500)], "id long, text string")
    got = {r.id: r.t for r in frame.select("id", toxicity.learned_text("text", 800).alias("t")).collect()}
    assert got[2] == "short" and len(got[3]) <= 207 and len(got[1].split("\n")) == 8
    assert all(p in text and len(p) == 25 for p in got[1].split("\n"))
