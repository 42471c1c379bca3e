"""Language-model scores, hard negatives and collocations against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelstone import scratch
from keelstone.llm import collocations, counting, hard_negatives, ngram_lm
from tests.conftest import rows
from tests.llm import helpers

VECTORS = "vec_id bigint, embedding array<float>, label int"


def shuffled_words(seed, n, vocabulary=30):
    random = np.random.default_rng(seed)
    # A few words are very common.
    at = (vocabulary * random.random(n) ** 3).astype(int)
    return " ".join(f"w{i}" for i in at)


# Sums and bitmaps


def test_add_up():
    keys = np.array([5, 1, 5, 2**63, 1], dtype=np.uint64)
    found, sums, _ = counting.add_up(keys)
    assert found.tolist() == [1, 5, 2**63] and sums.tolist() == [2, 2, 1]
    found, sums, tags = counting.add_up(keys, np.array([1, 10, 100, 7, 1000]), np.array([4, 3, 2, 1, 9]))
    assert sums.tolist() == [1010, 101, 7] and tags.tolist() == [3, 2, 1]
    empty = counting.add_up(np.zeros(0, np.uint64))
    assert len(empty[0]) == 0 == len(empty[1])


def test_buckets_rise_with_the_keys():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 10_000, dtype=np.uint64))
    bucket = counting.bucket_of(keys, 7)
    assert (np.diff(bucket) >= 0).all() and set(bucket) == set(range(7))


def test_deal_and_gather_over_many_flushes(spark, monkeypatch):
    monkeypatch.setattr(counting, "KEPT", 3)

    def work(block):
        words = [int(x) for t in block.column("text").to_pylist() for x in (t or "").split()]
        keys = np.array(words, dtype=np.uint64) << np.uint64(56)
        return [(0, keys, None, None), (1, keys, np.full(len(keys), 2), None)]

    def finish(kind, bucket, found):
        keys, sums, _ = found
        return pa.table({"kind": [kind] * len(keys), "key": (keys >> np.uint64(56)).astype(np.int64), "n": sums})

    df = helpers.docs(spark, [(i, " ".join(str(j % 11) for j in range(i))) for i in range(40)])
    dealt = counting.deal(df.select("text"), "text", work, [3, 5])
    found = counting.gather(dealt, finish, "kind long, key long, n long").collect()
    wanted = Counter(j % 11 for i in range(40) for j in range(i))
    assert {(r.kind, r.key): r.n for r in found} == {
        (k, w): n * (k + 1) for w, n in wanted.items() for k in (0, 1)
    }


def test_bitmap_has_all_its_keys(spark):
    keys = np.random.default_rng(3).integers(-(2**63), 2**63, 5000).tolist()
    made = counting.bitmap(spark.createDataFrame([(k,) for k in keys], "key bigint"))
    assert made.has(np.array(keys).astype(np.uint64)).all()
    others = np.random.default_rng(4).integers(0, 2**64, 5000, dtype=np.uint64)
    assert made.has(others).mean() < 0.01
    assert not counting.bitmap(spark.createDataFrame([], "key bigint")).has(others).any()


# Language model


def test_levels_and_filter():
    least = ngram_lm.LEAST
    assert least[:6].tolist() == [1, 2, 3, 4, 6, 8] and (np.diff(least) > 0).all()
    assert ngram_lm.level_of(np.array([1, 2, 5, 6, 10**9])).tolist()[:4] == [1, 2, 4, 5]
    random = np.random.default_rng(5)
    marks = np.unique(random.integers(0, 2**32, 300_000, dtype=np.uint32))
    counts = random.zipf(2.5, len(marks)).clip(1, 10**12)
    bits = np.frombuffer(ngram_lm.bucket_bits(marks, counts), np.uint8)
    found, true = ngram_lm.probe(bits, 0, marks), ngram_lm.level_of(counts)
    # Never too low, and seldom too high.
    assert (found >= true).all() and (found == true).mean() > 0.9
    others = random.integers(0, 2**32, 100_000, dtype=np.uint32)
    assert (ngram_lm.probe(bits, 0, others) > 0).mean() < 0.1


def brute_force_lm(texts, order):
    """{id: (n_tokens, n_known, base, score)} with the model's counts read through levels, without a filter."""
    marked = {i: ["<"] + helpers.words((t or "").translate(helpers.ASCII_LOWER)) + [">"] for i, (t, _) in texts.items()}
    grams = [Counter() for _ in range(order + 1)]
    single = Counter()
    for i, (_, training) in texts.items():
        if training:
            single.update(marked[i][1:])
            for n in range(1, order + 1):
                grams[n].update(tuple(marked[i][j : j + n]) for j in range(len(marked[i]) - n + 1))
    total, distinct = sum(single.values()), len(single)

    def quantised(gram):
        return ngram_lm.COUNT_OF[ngram_lm.level_of(np.array([grams[len(gram)][gram]]))[0]]

    out = {}
    for i, x in marked.items():
        score = 0
        for j in range(1, len(x)):
            p = (quantised((x[j],)) + 1) / (total + distinct + 1)
            for n in range(2, min(order, j + 1) + 1):
                context = quantised(tuple(x[j - n + 1 : j]))
                seen = min(quantised(tuple(x[j - n + 1 : j + 1])), context)
                p = (seen + ngram_lm.PRIOR * p) / (context + ngram_lm.PRIOR)
            score += math.log10(min(p, 1.0))
        base = sum(math.log10((single[w] + 1) / (total + distinct + 1)) for w in x[1:])
        out[i] = (len(x) - 1, sum(single[w] > 0 for w in x[1:]), base, score)
    return out, total


def lm_texts():
    texts = {i: (shuffled_words(i, 20 + 5 * i), i % 3 != 0) for i in range(40)}
    texts |= {
        100: (None, True), 101: ("", False), 102: (" \t\n", True), 103: ("UP up Up never-seen", False),
        104: ("x" * 200_000, True), 105: ("x" * 200_000, False), 106: (shuffled_words(9, 60_000), True),
    }
    return texts


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("broadcast", [True, False])
def test_lm_equals_brute_force(spark, monkeypatch, order, broadcast):
    monkeypatch.setattr(ngram_lm, "COMMON", 10)
    # A roomy filter: no false positive in so few n-grams.
    monkeypatch.setattr(ngram_lm, "BITS_PER_BYTE", 60.0)
    texts = lm_texts()
    wanted, total = brute_force_lm(texts, order)
    df = helpers.docs(spark, [(i, t) for i, (t, _) in texts.items()]).repartition(5)
    df = df.withColumn("n_tokens", F.lit("clash")).withColumn("row", F.lit(0)).withColumn("keys", F.lit(0))
    model = ngram_lm.learn(df, F.col("doc_id").isin([i for i, (_, training) in texts.items() if training]), order)
    assert model.buckets > 1
    found = ngram_lm.score(df, model, ngram_lm.BROADCAST_BYTES if broadcast else 0).collect()
    assert len(found) == len(texts)
    for r in found:
        n, known, base, score = wanted[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-8)
        assert r.score == pytest.approx(score, rel=1e-9)


def test_lm_asks_for_the_ngrams_of_a_block_once(spark, monkeypatch):
    """What is shuffled follows the distinct n-grams of a block and not those of each text."""
    monkeypatch.setattr(ngram_lm, "BITS_PER_BYTE", 60.0)
    verse = shuffled_words(1, 300)
    df = helpers.docs(spark, [(i, f"{verse} own{i % 5}") for i in range(400)]).coalesce(1)
    model = ngram_lm.learn(df, F.col("doc_id") % 7 != 2)
    texts = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    asked = ngram_lm._asked(ngram_lm._blocks(texts), model).collect()
    distinct = {g for t in (f"{verse} own{i}" for i in range(5)) for n in (1, 2)
                for w in [["<", *helpers.words(t), ">"]] for g in zip(*(w[j:] for j in range(n)))}
    # One more: the places of a text that no bigram ends at.
    assert sum(len(r.marks) // 4 for r in asked) == len(distinct) + 1
    assert len({(r.block, r.bucket) for r in asked}) == len(asked)


@pytest.mark.parametrize("rows_a_file", ["1", "7", "0"])
def test_lm_blocks_may_be_read_in_pieces(spark, settings, monkeypatch, rows_a_file):
    """Parts of a block that several tasks read, in any order, are looked up one by one."""
    settings(spark__sql__files__maxRecordsPerFile=rows_a_file, spark__sql__files__maxPartitionBytes="20000")
    monkeypatch.setattr(ngram_lm, "TEXT_BYTES", 5000)
    df = helpers.docs(spark, [(i, shuffled_words(i, 5 + 7 * i)) for i in range(60)] + [(99, None)]).repartition(3)
    model = ngram_lm.learn(df, F.col("doc_id") % 3 != 0)
    one, other = (sorted(map(tuple, ngram_lm.score(df, model, size).collect())) for size in (ngram_lm.BROADCAST_BYTES, 0))
    assert one == other


def test_lm_without_training_by_a_table(spark):
    df = helpers.docs(spark, [(None, "a b"), (1, "a b"), (1, "c"), (1, None)])
    model = ngram_lm.learn(df, F.lit(False))
    one, other = (sorted(map(repr, ngram_lm.score(df, model, size).collect())) for size in (ngram_lm.BROADCAST_BYTES, -1))
    assert one == other and len(one) == 4


def test_lm_learns_from_context(spark):
    verse = "the quick brown fox jumps over the lazy dog"
    df = helpers.docs(spark, [(i, verse) for i in range(2000)] + [(5000, verse), (5001, "dog lazy the over jumps fox brown quick the")])
    model = ngram_lm.learn(df, F.col("doc_id") < 5000)
    found = {r.doc_id: r for r in ngram_lm.score(df.where("doc_id >= 5000"), model).collect()}
    assert found[5000].base_score == pytest.approx(found[5001].base_score)
    assert found[5000].score > found[5000].base_score > found[5001].score


def test_lm_without_rows_ids_or_training(spark):
    none = helpers.docs(spark, [])
    model = ngram_lm.learn(none, F.lit(True))
    assert ngram_lm.score(none, model).collect() == []
    df = helpers.docs(spark, [(None, "a b"), (1, "a b"), (1, "a b"), (1, None)])
    scored = [tuple(r) for r in ngram_lm.score(df, model).collect()]
    assert sorted(scored, key=repr) == sorted(
        [(None, 3, 0, 0, 0.0, 0.0)] + [(1, 3, 0, 0, 0.0, 0.0)] * 2 + [(1, 1, 0, 0, 0.0, 0.0)], key=repr
    )


# Hard negatives


def brute_force_negatives(vectors, every, positives=5, negatives=3):
    own = []
    for row, (vec_id, vector, label) in enumerate(vectors):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((row, vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []

    def first(found, k):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1]))[:k]

    for row, vec_id, label, vector in own:
        if vec_id is None or vec_id % every:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, other[3])), other[1], other[2]) for other in own if other[0] != row
        ]
        for score, positive, _ in first([s for s in scored if s[2] == label], positives):
            fits = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score]
            for rank, (negative_score, negative, _) in enumerate(first(fits, negatives), 1):
                out.append((vec_id, positive, rank, negative, score, negative_score))
    return sorted(out, key=repr)


def random_vectors(seed, n, labels=4, size=6):
    random = np.random.default_rng(seed)
    centre = random.normal(size=(labels, size))
    label = (labels * random.random(n) ** 2).astype(int)
    values = (random.normal(size=(n, size)) + centre[label]) / 3
    return [(i, [float(np.float32(x)) for x in v], int(t)) for i, (v, t) in enumerate(zip(values, label))]


@pytest.mark.parametrize("block_rows, group_anchors", [(4096, 1024), (50, 7), (1, 1)])
def test_negatives_equal_brute_force(spark, block_rows, group_anchors):
    vectors = random_vectors(block_rows, 120 if block_rows == 1 else 400)
    df = spark.createDataFrame(vectors, VECTORS).repartition(4).withColumn("row", F.lit(1)).withColumn("score", F.lit("x"))
    found = hard_negatives.mine(
        df, F.col("vec_id") % 10 == 0, block_rows=block_rows, group_anchors=group_anchors
    )
    wanted = brute_force_negatives(vectors, 10)
    assert len(wanted) > 30 and rows(found) == wanted


def test_negatives_of_odd_rows(spark):
    same = [(i, [0.5, 0.25, 0.0], i % 3) for i in range(60)]
    vectors = random_vectors(8, 60, size=3) + same + same[:20] + [
        (None, [0.5, 0.3, 0.1], 1), (None, [0.6, 0.2, 0.0], 2), (100, None, 1), (110, [0.1, None, 0.2], 1),
        (120, [float("nan")] * 3, 1), (130, [float("inf"), 0.0, 0.0], 1), (140, [0.1, 0.2, 0.3], None),
        (150, [], 1), (160, [], 1), (170, [0.5], 1), (180, [-0.5, -0.25, 0.0], 2), (190, [0.0, 0.0, 0.0], 0),
    ]
    df = spark.createDataFrame(vectors, VECTORS)
    found = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, block_rows=16, group_anchors=3)
    assert rows(found) == brute_force_negatives(vectors, 10)
    none = hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0)
    assert none.collect() == [] and none.columns == found.columns


def test_scores_beyond_doubles():
    vectors = np.array([[2.0**40, 1.0], [2.0**40, 0.0], [2.0**33, 2.0**33], [-(2.0**62), 2.0**62]])
    lists = hard_negatives.Lists(np.array([4, 3, 2, 1]), vectors)
    anchor = np.array([2.0**20, 1.0])
    best = lists.best(anchor, [(-hard_negatives._LONG, hard_negatives._LONG)], 3)[0]
    # One unit apart, which doubles cannot tell; too large a sum is held at the end.
    assert best == [(2**60 + 1, 0), (2**60, 1), (2**53 + 2**33, 2)]
    low = lists.best(anchor, [(-hard_negatives._LONG, 0)], 1)[0]
    assert low == [(-hard_negatives._LONG, 3)]


def test_reading_stops_early(monkeypatch):
    """Where the lists fall fast, few rows are scored."""
    random = np.random.default_rng(2)
    vectors = np.floor(1000 * random.pareto(1.0, size=(4000, 3)))
    lists = hard_negatives.Lists(np.arange(4000), vectors)
    scored, plain = [], hard_negatives.Lists._scores

    def count(self, at, *others):
        scored.append(len(at))
        return plain(self, at, *others)

    monkeypatch.setattr(hard_negatives.Lists, "_scores", count)
    anchor = np.array([3.0, 2.0, 1.0])
    found = lists.best(anchor, [(0, hard_negatives._LONG)], 5)[0]
    assert [s for s, _ in found] == sorted((vectors @ anchor).astype(int), reverse=True)[:5]
    assert sum(scored) < 1000


# Collocations


def phrase_counts(texts):
    """{lang: (n, Counter of phrases)} by scanning pieces."""
    import re

    counts = defaultdict(lambda: [0, Counter()])
    for lang, text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(helpers.ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            own = counts[lang or "und"]
            own[0] += len(w)
            for n in range(1, 6):
                own[1].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return counts


def brute_force_collocations(texts, least, per_lang):
    out = []
    for lang, (n, f) in phrase_counts(texts).items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        own = []
        for p, a in candidates.items():
            if inside[p] < a:
                score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                own.append((-score, -a, " ".join(p).encode(), " ".join(p), a, l, r, n, score))
        out += [(lang, rank, *x[3:]) for rank, x in enumerate(sorted(own)[:per_lang], 1)]
    return sorted(out, key=repr)


def collocation_texts():
    verse = shuffled_words(77, 90, 400)
    texts = [("en" if i % 3 else "de", shuffled_words(i, 200) + (". " if i % 2 else " ") + verse) for i in range(30)]
    texts += [
        (None, "a b c. A  B\tc! a b"), ("und", "a b c"), (None, None), ("fr", ""), ("fr", ".,;:!?\n\r\x0b\x0c"),
        ("x", "go " * 300), ("x", "no stop " * 5000), ("en", "Été 中文 é"),
    ]
    return texts * 2


@pytest.mark.parametrize("trigger", [1, 2, 32])
def test_collocations_equal_brute_force(spark, monkeypatch, trigger):
    monkeypatch.setattr(collocations, "TRIGGER", trigger)
    texts = collocation_texts()
    df = spark.createDataFrame([(i, t, g, "s", 1) for i, (g, t) in enumerate(texts)], helpers.DOCS).repartition(7)
    df = df.withColumn("chunk", F.lit("clash")).withColumn("key", F.lit(1))
    for least, per_lang in ((4, 2000), (20, 10)):
        found = collocations.mine(df, least, per_lang)
        wanted = brute_force_collocations(texts, least, per_lang)
        assert len(wanted) > 20 and rows(found) == wanted


def test_chunks_count_every_word_once(spark):
    texts = collocation_texts()
    df = spark.createDataFrame([(i, t, g, "s", 1) for i, (g, t) in enumerate(texts)], helpers.DOCS)
    dictionary = collocations.parse(df).collect()
    counts = phrase_counts(texts)
    for lang, (n, _) in counts.items():
        assert sum(r.copies * r.starts for r in dictionary if r.lang == lang) == n
    # Equal passages share their chunks: far fewer are held than occur.
    assert sum(r.copies for r in dictionary) > 3 * len(dictionary)
    assert all(len(r.chunk.split(" ")) == r.starts + (0 if r.last else collocations.OVERLAP) for r in dictionary)


def test_a_frequent_phrase_is_spelled_by_one_chunk(spark):
    """However many chunks hold it."""
    texts = [(i, f"x{i} a b y{i}", "en", "s", 1) for i in range(500)]
    dictionary = scratch.stage(collocations.parse(spark.createDataFrame(texts, helpers.DOCS).repartition(6)), "chunks")
    assert dictionary.count() == 500
    ones = collocations._counted(dictionary, collocations._words_of, 8, 1, 100, 1, "words")
    shared = spark.sparkContext.broadcast(counting.bitmap(ones.select("key")))
    twos = collocations._counted(dictionary, collocations._pairs_of(shared), 8, 1, 100, 2, "pairs")
    assert [r["count"] for r in twos.collect()] == [500]
    shared = spark.sparkContext.broadcast(counting.bitmap(twos.select(F.col("spelled").alias("key"))))
    plan = collocations._phrases(dictionary, shared, 5)
    assert [r.phrase for r in plan.collect()] == ["a b"]


def test_collocation_scores_beyond_64_bits(spark):
    a, n, l = 10**12, 10**14, 10**13
    row = spark.createDataFrame([(a, n, l, l)], "a long, n long, l long, r long")
    assert row.select(F.expr(collocations.SCORE)).first()[0] == 1000 * a * n // (l * l)


def test_collocations_of_nothing(spark):
    assert collocations.mine(helpers.docs(spark, [])).collect() == []
    assert collocations.mine(helpers.docs(spark, [(1, None), (2, "one"), (3, " . ")])).collect() == []
