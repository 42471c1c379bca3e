import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelstone.llm import decontaminate, html_text, license_scan, packing, quality_rules, toxicity
from keelstone.llm.queries import tokenizer_path
from tests.llm import helpers

TRICKY = [
    None, "", " \n\t", "a", "Hello, World!", "it's we're I'll", "naïve café déjà ÉCOLE über Straße",
    "ÀÖØö ×÷ ÿ Ÿ İi ΣΑΣ ΟΔΟΣ K Å", "日本語 テスト 中文", "x\u00a0y \u2003 z\u200b", "e\u0301 e\u0308 n\u0303",
    "1234 12,345.67 a1b2", "<|endoftext|> <|startoftext|>x", "\x00\x01 \x1c a\x01b", "...!!! ?! a.b,c;",
    "word word word", "😀 emoji👍🏽 text", "a" * 5000, "Ünïcödé.,;:!?", "\u0130stanbul",
]


# Packing


def test_ids_equal_those_of_the_whole_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    words = packing.WordTokens(tokenizer_path())
    for _ in range(2):  # the second time from what is known
        ids, sizes = words.of(pa.array(TRICKY, pa.string()))
        at = 0
        for text, n in zip(TRICKY, sizes.tolist()):
            assert ids[at : at + n].tolist() == plain.encode(text or "", add_special_tokens=False).ids, text
            at += n


def check_packed(rows, texts, length):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens, r.ids))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = []
        for start, n, crc, total, piece in sorted(pieces[i]):
            assert start == len(ids) and n == len(piece)
            assert crc == zlib.crc32(np.array(piece, "<u4").tobytes())
            ids += piece
            assert total == sum(p[1] for p in pieces[i])
        assert ids == [*plain.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
    return len(sequences), sum(r.length for r in rows)


def test_packing_round_trip(spark):
    r = random.Random(4)
    texts = dict(enumerate(TRICKY))
    for i in range(100, 160):
        texts[i] = " ".join("word" * r.randint(1, 3) for _ in range(r.choice([3, 40, 500])))
    df = helpers.docs(spark, list(texts.items())).repartition(2)
    packed = packing.pack(df, tokenizer_path(), length=256, with_ids=True).collect()
    n, tokens = check_packed(packed, texts, 256)
    # Each of the two tasks leaves less than one sequence of padding.
    assert n * 256 - tokens < 2 * 256


def test_small_blocks_and_equal_rows(spark):
    df = helpers.docs(spark, [(1, "a b c")] * 5 + [(2, None)]).coalesce(1)
    packed = packing.pack(df, tokenizer_path(), length=8, block_tokens=4).collect()
    assert sum(p.length for p in packed) == 5 * 4 + 1
    assert packing.pack(helpers.docs(spark, []), tokenizer_path()).collect() == []


def test_rests_go_to_the_sequence_of_lowest_cost():
    pieces = packing.assign(np.array([90, 80, 20, 10]), 100)
    at = {doc: seq for doc, _, _, seq, _ in pieces}
    assert at[0] != at[1] and at[2] == at[1] and at[3] == at[0]
    cut = packing.assign(np.array([70, 70, 60]), 100)
    assert sum(p[2] for p in cut) == 200 and len({p[3] for p in cut}) == 2


def lowest_cost(sizes, length):
    """The placement of `assign`, by looking at every sequence for every document."""
    full = sum(n // length for n in sizes)
    rests = sorted(((n % length, i) for i, n in enumerate(sizes) if n % length), key=lambda r: (-r[0], r[1]))
    bins = [[] for _ in range(-(-sum(n for n, _ in rests) // length))]
    for size, doc in rests:
        def price(b):
            return sum(packing.LINEAR * n + packing.QUADRATIC * n * n for _, n in bins[b]), b

        def room(b):
            return length - sum(n for _, n in bins[b])

        fitting = [b for b in range(len(bins)) if room(b) >= size]
        if fitting:
            bins[min(fitting, key=price)].append((doc, size))
            continue
        while size:
            b = min((b for b in range(len(bins)) if room(b)), key=price)
            n = min(size, room(b))
            bins[b].append((doc, n))
            size -= n
    return full, bins


@pytest.mark.parametrize("seed", range(6))
def test_placement_equals_brute_force(seed):
    r = random.Random(seed)
    length = r.choice([64, 2048])
    # Many short pieces cost less than one long one: the cheapest sequence is often without room.
    sizes = [r.choice([r.randint(1, 12), r.randint(1, length), length // 2 + 1, 3 * length]) for _ in range(500)]
    full, bins = lowest_cost(sizes, length)
    pieces = packing.assign(np.array(sizes), length)
    placed = defaultdict(list)
    for doc, _, n, sequence, offset in pieces:
        placed[sequence].append((offset, doc, n))
    own = [[(doc, n) for _, doc, n in sorted(placed[full + b])] for b in range(len(bins))]
    assert own == bins
    assert all(len(placed[i]) == 1 and placed[i][0][2] == length for i in range(full))


def test_packing_ignores_other_columns(spark):
    texts = {1: "a b c", 2: None, 3: "", 4: "d " * 3000}
    df = helpers.docs(spark, list(texts.items())).selectExpr(
        "*", "1 AS start", "'x' AS length", "2 AS sequence_id", "3 AS ids", "4 AS offset"
    )
    check_packed(packing.pack(df, tokenizer_path(), with_ids=True).collect(), texts, packing.LENGTH)


# Quality rules


def quality_rows():
    r = random.Random(8)
    rows = [(i, t) for i, t in enumerate(TRICKY)]
    for i in range(40, 100):
        line = " ".join(r.choice(["aa", "bb", "cc#", "D$", "é|", "x" * 30]) for _ in range(r.randint(1, 14)))
        rows.append((i, "\n".join([line] * r.randint(1, 3) + [r.choice(["", " ", "tail"])])))
    return rows


def test_ledger_equals_brute_force(spark):
    rows = quality_rows()
    found = quality_rules.ledger(helpers.docs(spark, rows)).collect()
    texts = dict(rows)
    for r in found:
        expected = helpers.measures(texts[r.doc_id])
        assert {m: r[m] for m in expected} == expected, texts[r.doc_id]
        base = expected["n_words"] < 10 or 100 * expected["n_repeat_words"] > 20 * expected["n_words"]
        assert bool(r.failed_bits & quality_rules.mask(quality_rules.POLICIES["base"])) == base


def test_policies_and_ablations_come_from_the_bits(spark):
    rows = quality_rules.ledger(helpers.docs(spark, quality_rows()))
    judged = quality_rules.apply_policies(rows, ["base", "v1", "v2"]).collect()
    assert all(r.kept_base or not r.kept_v1 for r in judged)
    assert all(r.kept_v1 or not r.kept_v2 for r in judged)
    found = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablations(rows, "v1").collect()}
    bits = [r.failed_bits & quality_rules.mask(quality_rules.POLICIES["v1"]) for r in judged]
    for i, rule in enumerate(quality_rules.RULES):
        if rule.name in quality_rules.POLICIES["v1"]:
            expected = (sum(bool(b >> i & 1) for b in bits), sum(b == 1 << i for b in bits))
            assert found[rule.name] == expected


def test_keep_good_keeps_rows_as_they_are(spark):
    good = "These are ten plain words that nobody would ever reject here."
    rows = [(1, good), (1, good), (2, None), (3, "short"), (None, good), (5, "a " * 100)]
    df = helpers.docs(spark, rows).selectExpr("*", "7 as n_words", "8 as failed_bits")
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r.n_words) for r in kept.collect()) == [
        (0, good, 7), (1, good, 7), (1, good, 7)
    ]
    assert quality_rules.keep_good(helpers.docs(spark, [])).collect() == []
    assert quality_rules.ledger(helpers.docs(spark, [])).collect() == []


# Decontamination


def test_distance_equals_the_plain_table():
    r = random.Random(2)
    for _ in range(200):
        a = "".join(r.choice("abc") for _ in range(r.randint(1, 12)))
        b = "".join(r.choice("abc") for _ in range(r.randint(0, 20)))
        best, end = decontaminate.distance(a.encode(), b.encode())
        assert best == helpers.edit_distance_inside(a, b)
        assert 0 <= end <= len(b)


def _sentence(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(2, 8))) for _ in range(n))


def test_edited_items_are_found_and_others_are_not(spark):
    r = random.Random(6)
    items = [(i, _sentence(r, r.randint(15, 50))) for i in range(30)]
    rows, truth = [], {}
    random_ = np.random.default_rng(5)
    for i in range(120):
        text, number = _sentence(r, 60), None
        if i % 2:
            number, item = items[i // 2 % len(items)]
            edited = decontaminate._edited(item.encode(), int(0.1 * len(item)), random_).decode()
            text = f"{text} {edited.upper() if i % 3 else edited}\n {text}"
        rows.append((i, text))
        truth[i] = number
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.hits(helpers.docs(spark, rows), table).collect()
    got = {r.doc_id: r.item_id for r in found}
    assert all(truth[d] == i for d, i in got.items())
    missed = [d for d, i in truth.items() if i is not None and d not in got]
    assert len(missed) <= 1
    texts = dict(rows)
    for hit in found:
        item = dict(items)[hit.item_id]
        assert hit.distance <= 0.15 * len(item)
        passage = helpers.words(texts[hit.doc_id])[hit.first_word : hit.last_word + 1]
        assert helpers.edit_distance_inside(item, " ".join(passage).lower()) == hit.distance


def test_decontamination_edge_cases(spark):
    item = "the quick brown fox jumps over the lazy dog"
    table = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "two words")], "item_id bigint, text string"
    )
    rows = [(1, item), (1, item), (2, None), (3, ""), (4, "two words"), (None, item), (6, "x " * 30_000 + item)]
    df = helpers.docs(spark, rows).selectExpr("*", "1 as leaks")
    found = decontaminate.hits(df, table).collect()
    assert sorted((r.doc_id or 0, r.distance, r.first_word) for r in found) == sorted(
        [(0, 0, 0)] * 2 + [(1, 0, 0)] * 4 + [(6, 0, 30_000)] * 2
    )
    kept = decontaminate.clean(df, table)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert decontaminate.hits(df, table.limit(0)).collect() == []
    assert decontaminate.clean(df, table.limit(0)).count() == len(rows)
    assert decontaminate.hits(df.limit(0), table).collect() == []


def test_items_in_several_blocks(spark):
    r = random.Random(9)
    items = [(i, _sentence(r, 20)) for i in range(12)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    blocks = list(decontaminate.item_blocks(table, limit=400))
    assert len(blocks) > 3 and sorted(i for b in blocks for i in b.ids) == list(range(12))


def test_items_without_long_words_or_spaces_are_found(spark):
    r = random.Random(11)
    rows, items = [], []
    for i in range(60):
        item = "".join(r.choice("ab c") for _ in range(r.randint(1, 30)))
        items.append((i, item))
        rows.append((i, "".join(r.choice("ab c") for _ in range(r.randint(0, 60)))))
    glued = "the quick brown fox jumps over the lazy dog"
    spoken = "我们的语言模型在这个测试题目上面不应该看到答案"
    items += [(100, glued), (101, spoken), (102, "two words")]
    rows += [(100, f"xyz{glued.replace(' ', '')}xyz"), (101, f"前面{spoken[:9]}很{spoken[10:]}后面"), (102, "Two  words")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.hits(helpers.docs(spark, rows), table, short_items=True).collect()
    expected = {}
    for d, text in rows:
        text = " ".join(helpers.words(text)).lower().encode().decode("latin-1")
        for i, item in items:
            item = " ".join(helpers.words(item)).encode().decode("latin-1")
            distance = helpers.edit_distance_inside(item, text)
            if item and text and distance <= int(0.15 * len(item)):
                expected[d, i] = distance
    assert {(x.doc_id, x.item_id): x.distance for x in found} == expected
    assert {(101, 101), (102, 102)} <= set(expected)
    usual = {(x.doc_id, x.item_id) for x in decontaminate.hits(helpers.docs(spark, rows), table).collect()}
    assert (101, 101) in usual


@pytest.mark.parametrize("share", [0.1, 0.14, 0.15])
def test_no_edited_copy_within_the_distance_is_lost(spark, share):
    r, random_ = random.Random(12), np.random.default_rng(8)
    items = [(i, _sentence(r, r.randint(15, 50))) for i in range(60)]
    rows = []
    for i, item in items:
        edits = int(share * len(item))
        rows.append((i, decontaminate._edited(item.encode(), edits, random_).decode()))
        # Changed letters only, spread evenly: nearly no word stays as it is.
        letters = list(item)
        for j in range(edits):
            letters[j * len(item) // edits] = "#"
        rows.append((100 + i, "".join(letters)))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    hits = decontaminate.hits(helpers.docs(spark, rows), table).collect()
    found = {(x.doc_id, x.item_id) for x in hits}
    texts, lost = dict(items), []
    for d, text in rows:
        item = texts[d % 100]
        near = decontaminate.distance(item.encode(), " ".join(helpers.words(text)).encode())[0]
        if near <= int(0.15 * len(item)) and (d, d % 100) not in found:
            lost.append(d)
    assert lost == []


# Toxicity


def test_folding():
    assert toxicity.fold("IDI0T") == toxicity.fold("ΙdΙot") == toxicity.fold("1d!ot")
    assert toxicity.fold("Cl0wn") == toxicity.fold("clown") == toxicity.fold("сlоwn")
    assert len(toxicity.fold("$cum!! 5% | x")) == len("$cum!! 5% | x")
    assert len(toxicity.fold("A\u0130B")) == 3


def test_matches_are_beginnings_of_words_outside_exceptions():
    matcher = toxicity.Matcher([toxicity.fold("trash"), toxicity.fold("clown")], ["trash can", "class clown"])
    count = lambda t: sum(matcher.counts(t).values())
    assert count("Tr4sh! trashy untrash") == 2
    assert count("the trash can and a class clown") == 0
    assert count("trash cannot") == 1
    assert toxicity.Matcher([]).counts("trash") == {}


def test_learned_lexicon_on_held_out_rows(spark):
    r = random.Random(3)
    bad = ["zorgle", "blivvet", "snarfing", "quaddle"]
    rows, labels = [], []
    for i in range(400):
        words = _sentence(r, r.randint(20, 60)).split()
        toxic = int(r.random() < 0.25)
        if toxic:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(bad).replace("o", r.choice("o0"))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    docs = helpers.docs(spark, rows + [(1000, None), (1001, ""), (None, "zorgle")])
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    lexicon = toxicity.learn(docs, table.where("doc_id % 4 <> 2"))
    found = {x.doc_id: x.score for x in toxicity.score(docs, lexicon).collect()}
    truth = {i: t for i, _, t in labels}
    held = [i for i in truth if i % 4 == 2]
    assert all((found[i] >= toxicity.THRESHOLD) == bool(truth[i]) for i in held)
    assert found[1000] == found[1001] < toxicity.THRESHOLD
    assert all(0 <= s <= 1 for s in found.values())


def test_counts_equal_brute_force():
    r = random.Random(12)
    terms = ["bad", "ba.", "bad.", "clown", "clowns.", "x.", "tra"]
    phrases = ["class clown", "bad bad wolf"]
    alphabet = ["bad", "badly", "ba", "clown", "clowns", "class", "x", "xx", "tr4sh", "wolf", "B4D", "cl0wn"]
    matcher = toxicity.Matcher([toxicity.fold(t) for t in terms], phrases)
    for _ in range(300):
        text = r.choice([" ", ", ", "-"]).join(r.choice(alphabet) for _ in range(r.randint(0, 12)))
        folded = toxicity.fold(text)
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", folded)]
        edges = {a for a, _ in words}, {b for _, b in words}
        excused = [
            (m.start(), m.start() + len(p)) for p in map(toxicity.fold, phrases)
            for m in re.finditer(f"(?={re.escape(p)})", folded)
            if m.start() in edges[0] and m.start() + len(p) in edges[1]
        ]
        wanted = {}
        for term in map(toxicity.fold, terms):
            word = term.rstrip(".")
            n = sum(
                folded.startswith(word, a) and (term == word or a + len(word) == b)
                and not any(x <= a and a + len(word) <= y for x, y in excused)
                for a, b in words
            )
            if n:
                wanted[term] = n
        assert matcher.counts(text) == wanted, text


def _insults(spark, insult, n=600, toxic_share=0.3, extra=()):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = _sentence(r, r.randint(20, 60)).split()
        toxic = int(r.random() < toxic_share)
        if toxic:
            words[r.randrange(len(words))] = insult(r)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return helpers.docs(spark, rows + list(extra)), table, {i: t for i, _, t in labels}


@pytest.mark.parametrize("insult", [
    lambda r: "zyx", lambda r: "qq", lambda r: r.choice(["zorgle", "zorgles", "Z0RGLING"]),
    # Twenty insults, each in few of the toxic documents.
    lambda r: f"zk{'abcdefghij'[r.randrange(10)]}{'xy'[r.randrange(2)]}",
    lambda r: "extraordinarilylongw" + "o" * 30,
])
def test_insults_of_any_length_and_share(spark, insult):
    docs, table, truth = _insults(spark, insult, 800)
    scores = []
    for more in ({}, {"candidates": 1000, "min_share": 0.0}):
        lexicon = toxicity.learn(docs, table.where("doc_id % 4 <> 2"), **more)
        found = {x.doc_id: x.score >= toxicity.THRESHOLD for x in toxicity.score(docs, lexicon).collect()}
        scores.append([found[i] for i in truth if i % 4 == 2])
    held = [bool(truth[i]) for i in truth if i % 4 == 2]
    assert sum(a == b for a, b in zip(scores[0], held)) >= 0.95 * len(held)
    assert scores[0] == scores[1]


def test_toxicity_of_odd_rows(spark):
    long_text = "zorgle " * 100_000
    extra = [(None, "zorgle"), (7000, long_text), (7001, "\u0130" * 50), (1, "zorgle"), (1, "zorgle"), (7002, None)]
    docs, table, _ = _insults(spark, lambda r: "zorgle", extra=extra)
    docs = docs.withColumn("toxic", F.lit("x")).withColumn("term", F.lit(1)).withColumn("score", F.lit(2))
    sample = toxicity._sample(docs, table, 10**6)
    assert sample.count() == 600
    found = toxicity.score(docs, toxicity.learn(docs, table)).collect()
    assert len(found) == 606 and {r.n_hits for r in found if r.doc_id == 7000} == {100_000}
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.n_hits for r in found if r.doc_id in (7001, 7002)} == {0}


def test_toxicity_without_labels(spark):
    docs = helpers.docs(spark, [(1, "a"), (1, "a"), (2, None)])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert [r.score < 0.001 for r in found] == [True] * 3
    assert toxicity.score(docs.limit(0), toxicity.Lexicon()).collect() == []


# HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var t="</p><p>not text</p>";</script></head><body>
<header><h1>Site</h1><p>A slogan for the whole site, with quite some words in it.</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for all of you.</p></div>
<article><h1>Caf&eacute; &amp; more</h1><p>First  paragraph with <b>bold</b>
 words &lt;b&gt; and&nbsp;a <a href="x">link</a>.<br>Next line.<p>Second paragraph<!-- no --> goes on.
<form><p>Subscribe to our letter now, it is free of charge.</p><input></form>
<ul><li>An item<li>Another item</ul><aside>Related things one might want to read after this.</aside>
<section class="comments"><p>I do not agree with any of this article, said a reader.</p></section>
<p>Last one.</p></article><div id="sidebar">Popular now: many other things to read here today.</div>
<footer>&copy; 2020 The site, all rights and wrongs reserved.</footer></body></html>"""


def test_article_of_a_page():
    assert html_text.main_text(PAGE, html_text.train()).split("\n") == [
        "Café & more", "First paragraph with bold words <b> and a link. Next line.",
        "Second paragraph goes on.", "An item", "Another item", "Last one.",
    ]


@pytest.mark.parametrize("page,expected", [
    (None, ""), ("", ""), ("<p", ""), ("<!-- open", ""), ("<script>x", ""),
    ("<article><p>one two &am three", "one two &am three"),
    ("<article><p>a < b and 3 > 2</p></article>", "a < b and 3 > 2"),
    ("<article><h2>x</h2><p>y</article>", "x\ny"),
    ("<article><p title='a > b'>y</p><div class=ad>z</div></article>", "y"),
])
def test_odd_pages(page, expected):
    assert html_text.main_text(page, html_text.train()) == expected


def text_of(page):
    return html_text.main_text(page, html_text.train()).split("\n")


def n_words(n, mark="word"):
    return " ".join([mark] * n)


@pytest.mark.parametrize("page", [
    '<body class="has-sidebar"><article><h1>A title</h1><p>{0}</p></article></body>',
    '<html class="no-header"><body class="single-post menu"><div><h1>A title</h1><p>{0}</p></div></body></html>',
    '<div class="page-header-wide"><h1>A title</h1><p>{0}</p></div>',
    '<article><header class="entry-header"><h1>A title</h1></header><p>{0}</p></article>',
    '<form class="page"><main><h1>A title</h1><p>{0}</p></main></form>',
    '<div id="sidebar-left"><p>Popular now</p></div><h1>A title</h1><p>{0}</p>',
    '<div class="site-header">The site</div><h1>A title</h1><p>{0}</p>',
])
def test_layout_classes_lose_no_page(page):
    assert text_of(page.format(n_words(40))) == ["A title", n_words(40)]


@pytest.mark.parametrize("lengths", [[60], [60, 50, 12], [60, 9, 70, 30], [30, 11], [200, 40, 15, 80]])
def test_pages_without_an_article(lengths):
    paragraphs = [n_words(n) for n in lengths]
    assert text_of("".join(f"<p>{p}</p>" for p in paragraphs)) == paragraphs
    menu = "<ul><li><a href=x>One</a><li><a href=y>Two more</a></ul><div>We use cookies, as all do, for you to have a good day.</div>"
    page = menu + "<h1>Five words make a heading</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "<div>The end</div>"
    assert text_of(page) == ["Five words make a heading", *paragraphs]


def test_parts_of_an_article():
    page = (
        f"<article><header><h1>Title</h1></header><figure><img><figcaption>A caption</figcaption></figure>"
        f"<p>{n_words(30)} <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p><address>By me</address></article>"
        f"<section id=comments><article class=comment><p>{n_words(30, 'no')}</p></article></section>"
    )
    assert text_of(page) == ["Title", "A caption", n_words(30) + " x=1", "By me"]


def test_quotes_in_attributes():
    assert text_of("<article><p><a title=it's>link</a> and the rest of it.</p><p>It's next</p></article>") == [
        "link and the rest of it.", "It's next"
    ]
    assert text_of("<article><p data-x='a > b' title = \"c > d\">y z</p></article>") == ["y z"]


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "x", "<div><b>" * 50_000 + "x" + "</b></div>" * 50_000, "<p><i>" * 100_000, "</div>" * 100_000,
    '<a title="' * 100_000, "<ul><li>" * 50_000 + "</li>" * 50_000,
])
def test_deep_pages_take_time_in_proportion(page):
    started = time.perf_counter()
    text_of(page)
    assert time.perf_counter() - started < 10


def test_tree_uses_own_words_and_neighbours():
    tree = html_text.train()
    rows = html_text.labelled()
    assert sum(html_text.classify(tree, row) == row[-1] for row in rows) >= 0.95 * len(rows)
    right = 0
    for i, page in enumerate(html_text.PAGES):
        # Held out: a page that the tree has not seen.
        other = html_text.train(html_text.labelled(html_text.PAGES[:i] + html_text.PAGES[i + 1 :]))
        right += sum(html_text.classify(other, row) == row[-1] for row in html_text.labelled([page]))
    assert right >= 0.88 * len(rows)

    def used(node):
        return set() if isinstance(node, int) else {html_text.FEATURES[node[0]]} | used(node[2]) | used(node[3])

    assert {"words", "link_density"} <= used(tree) and used(tree) & {"before_density", "before_words"}
    assert used(tree) & {"after_words", "after_density"}
    found = html_text.blocks("<p>a b</p><p><a>c d e</a></p>")
    rows = html_text.features(found)
    assert rows[0][4:6] == (3, 1.0) and rows[1][2:4] == (2, 0.0)


def test_extract_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article><p>x" + " y" * 200_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as text")
    found = html_text.extract(df).collect()
    assert [r.n_chars for r in found] == [len(r.text) for r in found]
    assert [r.page_id for r in found] == [1, 1, 2, None] and found[2].text == ""
    assert found[3].n_chars == 400_001
    assert html_text.extract(df.limit(0)).collect() == []


# Licenses


def test_license_passages_and_phrases(spark):
    mit = license_scan.TEMPLATES["mit"]
    rows = [
        (1, f"some code\n# {mit}, more"), (2, mit.replace("free of charge, ", "free of any charge, ")),
        (3, "CC-BY is fine, cc by too; General public\nLICENSE"), (4, "All rights. Reserved? all rights re served"),
        (5, None), (6, ""), (7, "permission is hereby granted to leave the room"), (7, "x " * 60_000),
        (8, "all rİghts reserved, ALL RIGHTS RESERVED"), (9, "Released under the MIT License."),
        (None, "cc by"), (11, "by cc"),
    ]
    df = helpers.docs(spark, rows).selectExpr("*", "1 as words", "2 as row")
    got = sorted(
        (r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)
        for r in license_scan.scan(df).collect()
    )
    n = len(license_scan.template_words(mit))
    assert got == [
        (0, 2, 1, 0, 0, "cc-by", "cc-by"), (1, n + 3, 0, None, None, "", "mit"),
        (2, n + 1, 0, None, None, "", "mit"), (3, 10, 3, 0, 7, "cc-by,gpl", "cc-by,gpl"),
        (4, 7, 1, 0, 0, "reserved", "reserved"), (5, 0, 0, None, None, "", ""), (6, 0, 0, None, None, "", ""),
        (7, 8, 0, None, None, "", ""), (7, 60_000, 0, None, None, "", ""),
        (8, 6, 1, 3, 3, "reserved", "reserved"), (9, 5, 0, None, None, "", "mit"), (11, 2, 0, None, None, "", ""),
    ]
    assert license_scan.scan(df.limit(0)).collect() == []


def test_every_run_that_is_looked_up_needs_a_rare_word(spark):
    runs, needed = license_scan._runs(spark, license_scan.TEMPLATES)
    assert not set(needed) & license_scan.COMMON
    assert runs.where("t_at < 0 or size(t_words) < t_at + 4").count() == 0
    assert {r[0] for r in runs.select("template").distinct().collect()} == set(license_scan.TEMPLATES)


def license_labels(text):
    """Labels by comparing every run of the text with every run of every template."""
    k, common = license_scan.K, license_scan.COMMON
    w = license_scan.template_words(text)
    found = {label for phrase, label in license_scan.PHRASES.items()
             if any(w[i : i + len(phrase.split())] == phrase.split() for i in range(len(w)))}
    by_label = defaultdict(set)
    for name, template in license_scan.TEMPLATES.items():
        by_label[name.split("/")[0]] |= set(license_scan.template_words(template))
    for name, template in license_scan.TEMPLATES.items():
        t, label = license_scan.template_words(template), name.split("/")[0]
        own = set(t) - set().union(*(x for other, x in by_label.items() if other != label))
        diagonals = sorted({
            i - j for i in range(len(w) - k + 1) for j in range(len(t) - k + 1)
            if w[i : i + k] == t[j : j + k] and set(t[j : j + k]) - common
        })
        clusters = []
        for d in diagonals:
            if clusters and d - clusters[-1][-1] <= license_scan.MERGE:
                clusters[-1].append(d)
            else:
                clusters.append([d])
        for c in clusters:
            inside = set(w[max(c[0], 0) : c[-1] + len(t)])
            share = len(inside & set(t)) / len(set(t))
            if share >= license_scan.MIN_SHARE and (not own or len(inside & own) / len(own) >= license_scan.MIN_OWN):
                found.add(label)
    return ",".join(sorted(found))


def test_labels_equal_brute_force(spark):
    r = random.Random(21)
    texts = {}
    for i in range(150):
        words = _sentence(r, r.randint(0, 20)).split()
        for _ in range(r.randint(0, 3)):
            t = r.choice(list(license_scan.TEMPLATES.values())).split()
            t = t[r.choice([0, 0, 2]) : len(t) - r.choice([0, 0, 3])]
            for _ in range(r.randint(0, 4)):
                at = r.randrange(len(t) + 1)
                t[at : at + r.randint(0, 1)] = r.choice([[], ["other"], ["an", "extra"]])
            words += t + _sentence(r, r.randint(1, 8)).split()
        texts[i] = " ".join(words)
    found = {x.doc_id: x.labels for x in license_scan.scan(helpers.docs(spark, list(texts.items()))).collect()}
    assert found == {i: license_labels(t) for i, t in texts.items()}
    assert sum(bool(v) for v in found.values()) > 60


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-NC 3.0", "cc-by,cc-by-nc"), ("Licensed under CC BY-SA 2.0", "cc-by,cc-by-sa"),
    ("Licensed under CC BY 4.0", "cc-by"), ("SPDX-License-Identifier: MIT", "mit"),
    ("Redistribution and usage in source or binary forms, with or without modification, is permitted "
     "provided that the following conditions are met", "bsd"),
    ("the source code is governed by nobody", ""),
])
def test_changed_passages(spark, text, labels):
    assert license_labels(text) == labels
    assert license_scan.scan(helpers.docs(spark, [(1, text)])).first().labels == labels
