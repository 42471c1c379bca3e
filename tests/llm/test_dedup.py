import hashlib
import random

import numpy as np
import pytest

from keelstone.llm import ngram_join, substring_dedup
from keelstone.llm.components import components
from tests.llm import helpers


def _word(random_):
    return "".join(random_.choice("abcdef") for _ in range(random_.randint(2, 5)))


def near_copies(seed=1):
    """Texts with exact and near copies of many sizes, around both thresholds."""
    r = random.Random(seed)
    rows, number = [], 0
    for size in (1, 2, 3, 5, 9, 12, 14, 17, 18, 22, 26, 30, 45, 80, 150, 400):
        base = [_word(r) for _ in range(size)]
        for copy in range(6):
            w = list(base)
            for _ in range(r.randint(0, 1 + size // 25) if copy else 0):
                w[r.randrange(len(w))] = _word(r)
            if copy == 4:
                w = w + [_word(r)]
            text = " ".join(w)
            rows.append((number, text.upper() if copy == 5 else text))
            number += 1
    r.shuffle(rows)
    return [(i, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 60), (3, 100)])
def test_components_equal_all_pairs(spark, k, percent):
    rows = near_copies()
    found = ngram_join.jaccard_components(helpers.docs(spark, rows), k, percent).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got == helpers.components(rows, k, percent)


@pytest.mark.parametrize("light", [0, 1, 2])
def test_light_and_heavy_forms_agree(spark, monkeypatch, light):
    monkeypatch.setattr(ngram_join, "choose_light", lambda *_: light)
    rows = near_copies(2)
    found = ngram_join.jaccard_components(helpers.docs(spark, rows), 2, 85).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got == helpers.components(rows, 2, 85)


def test_boundary_follows_the_cost():
    few, many = [(12, 50)], [(12, 10**9)]
    assert ngram_join.choose_light(few, 90) == 0
    assert ngram_join.choose_light(many, 90) == 1
    assert ngram_join.choose_light(many, 100) == 0


def test_bitmaps_bound_the_difference():
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 2**63, 300).astype(np.uint64))
    b = np.unique(np.concatenate((a[:200], r.integers(0, 2**63, 90).astype(np.uint64))))
    bits = ngram_join.bitmaps(np.concatenate((a, b)), np.array([len(a), len(b)]))
    differ = sum(int(x ^ y).bit_count() for x, y in zip(*bits.view(np.uint64).tolist()))
    assert differ <= len(np.setxor1d(a, b))


def test_large_bitmaps_bound_the_difference():
    r = np.random.default_rng(0)
    a, other = (np.unique(r.integers(0, 2**63, 5000).astype(np.uint64)) for _ in range(2))
    b = np.unique(np.concatenate((a[:2000], other[:600])))  # its bitmap is half as long
    x, y, z = map(ngram_join.large_bitmap, (a, b, other))
    assert len(x) == 2 * len(y)
    assert ngram_join.bits_apart(x, x) == 0
    assert 0 < ngram_join.bits_apart(x, y) == ngram_join.bits_apart(y, x) <= len(np.setxor1d(a, b))
    # Sets without a common element are told apart at a similarity of 0.8.
    assert 180 * ngram_join.bits_apart(x, z) > 20 * (len(a) + len(other))


def test_hashes_of_large_unlike_sets_are_not_compared(spark, monkeypatch):
    """Large documents share cells by chance; as pairs they would grow with the square of their number."""
    real, staged = ngram_join.stage, []

    def counted(df, label):
        staged.append((label, real(df, label)))
        return staged[-1][1]

    monkeypatch.setattr(ngram_join, "stage", counted)
    common = " ".join(f"c{j}" for j in range(300))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(3000)) + " " + common) for i in range(24)]
    rows.append((100, rows[3][1] + " more"))
    likely = []
    monkeypatch.setattr(
        ngram_join, "drop", lambda *tables: likely.extend(t.count() for label, t in staged if label == "likely")
    )
    found = ngram_join.jaccard_components(helpers.docs(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: 3 if i == 100 else i for i, _ in rows}
    assert max(likely) == 1


def test_join_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three"),
        (7, "one two three"), (None, "one two three"), (9, "x " * 50_000), (10, "x"),
    ]
    found = ngram_join.jaccard_components(helpers.docs(spark, rows), 3, 90).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in found)
    assert got == [
        (False, 1, 0, 1), (False, 2, 0, 2), (False, 3, 0, 3), (False, 4, 1, 4), (False, 5, 1, 4),
        (False, 6, 1, 6), (False, 7, 1, 7), (False, 7, 1, 7), (False, 9, 1, 9), (False, 10, 1, 10),
        (True, 0, 1, None),
    ]


def test_one_id_with_several_texts(spark):
    rows = [(1, "a b c d"), (1, "p q r s"), (2, "a b c d"), (3, "p q r s")]
    found = ngram_join.jaccard_components(helpers.docs(spark, rows), 3, 90).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (2, 1), (3, 1)]


def test_every_text_of_an_id_is_compared(spark):
    a, b, c = "a b c d e f", "p q r s t u", "k l m n o"
    near = " ".join(str(i) for i in range(40))
    rows = [(5, a), (5, f"{near} x"), (4, near), (3, a), (7, b), (9, b), (9, c), (8, c), (None, a), (6, ""), (6, "z")]
    found = ngram_join.jaccard_components(helpers.docs(spark, rows), 3, 90).collect()
    assert sorted((x.doc_id or 0, x.component_id) for x in found) == [
        (0, None), (3, 3), (4, 3), (5, 3), (5, 3), (6, 6), (6, 6), (7, 7), (8, 7), (9, 7), (9, 7)
    ]


def test_keep_one_keeps_columns_and_first_documents(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words here to keep alone"), (4, None)]
    df = helpers.docs(spark, rows).selectExpr("*", "1 as n", "2 as key", "3 as component_id")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_keep_one_keeps_rows_without_an_id(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "other words"), (None, None)]
    kept = ngram_join.keep_one(helpers.docs(spark, rows)).collect()
    assert sorted((x.doc_id or 0, x.text or "") for x in kept) == [
        (0, ""), (0, "a b c d e f g"), (0, "other words"), (1, "a b c d e f g")
    ]


def test_join_of_an_empty_table(spark):
    df = helpers.docs(spark, [])
    assert ngram_join.jaccard_components(df).collect() == []
    assert ngram_join.keep_one(df).collect() == []


def test_components_of_chains_and_rings(spark):
    edges = [(i, i + 1) for i in range(40, 70)] + [(3, 2), (2, 1), (1, 3), (9, 8), (5, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.id: r.component_id for r in components(df).collect()}
    assert got == {**{i: 40 for i in range(40, 71)}, 1: 1, 2: 1, 3: 1, 8: 8, 9: 8}


def passages(seed=3):
    r = random.Random(seed)
    shared = [[_word(r) for _ in range(n)] for n in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(60):
        w = [_word(r) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            part = list(r.choice(shared))
            if r.random() < 0.4:
                part[r.randrange(len(part))] = _word(r)
            if r.random() < 0.3:
                part = part[r.randrange(5) :]
            w += part + [_word(r) for _ in range(r.randint(0, 5))]
        rows.append((i, r.choice(" \n").join(w)))
    rows += [(60, "x " * 200), (61, "x " * 13), (62, "x " * 12), (63, rows[5][1]), (64, rows[5][1])]
    r.shuffle(rows)
    return rows


def test_removed_words_equal_brute_force(spark):
    rows = passages()
    expected = {
        i: (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
        for i, (w, gone) in helpers.repeats(rows).items()
    }
    found = substring_dedup.digest(helpers.docs(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == expected


def test_rows_of_one_id_lose_only_their_own_words(spark):
    text = " ".join(str(i) for i in range(15))
    other = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text), (2, "two words"), (2, text), (2, other), (3, f"{other} end"), (None, text)]
    df = helpers.docs(spark, rows)
    found = substring_dedup.digest(df).collect()
    assert sorted((x.doc_id or 0, x.n_words, x.n_removed) for x in found) == [
        (0, 15, 0), (1, 15, 0), (2, 2, 0), (2, 15, 15), (2, 20, 0), (3, 21, 20)
    ]
    kept = substring_dedup.remove_repeats(df)
    assert kept.columns == df.columns
    assert sorted((x.doc_id or 0, x.text) for x in kept.collect()) == [
        (0, text), (1, text), (2, "two words"), (2, other), (3, "end")
    ]


def test_only_long_repeats_go(spark):
    r = random.Random(5)
    long, short = " ".join(_word(r) for _ in range(60)), " ".join(_word(r) for _ in range(20))
    rows = [(1, f"{long} one {short}"), (2, f"two  {short}\n"), (3, f"three {long} four"), (4, long), (5, None)]
    df = helpers.docs(spark, rows).selectExpr("*", "1 as ranges", "2 as all_gone", "3 as range_id")
    kept = substring_dedup.remove_repeats(df, 50)
    assert kept.columns == df.columns
    got = {x.doc_id: x.text for x in kept.collect()}
    # Texts without a long repeat stay as they are; a text that is nothing else goes.
    assert got == {1: rows[0][1], 2: rows[1][1], 3: "three four", 5: None}


def test_repeats_edge_cases(spark):
    text = " ".join(str(i) for i in range(15))
    rows = [(2, text), (2, text), (None, text), (3, text), (1, ""), (0, None)]
    found = substring_dedup.digest(helpers.docs(spark, rows)).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_words, x.n_removed) for x in found) == [
        (False, 0, 0, 0), (False, 1, 0, 0), (False, 2, 15, 0), (False, 2, 15, 0), (False, 3, 15, 15),
        (True, 0, 15, 0),
    ]
    assert substring_dedup.digest(helpers.docs(spark, [])).collect() == []
