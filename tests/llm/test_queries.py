"""The registered queries over the smallest tables, and the pipeline against brute force."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from check import connect, difference
from keelstone.llm import decontaminate, packing, quality_rules
from keelstone.llm.queries import ORACLES, QUERIES, table, tokenizer_path
from suite import ORACLES as OTHER_ORACLES, QUERIES as OTHER_QUERIES
from tests.llm import helpers
from tests.llm.test_text_operators import check_packed

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_all_queries_are_registered():
    found = __spark_entry__.queries()
    assert set(QUERIES) < set(found) and "pipeline" in found
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert not set(QUERIES) & set(OTHER_QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, monkeypatch, name):
    monkeypatch.setitem(OTHER_QUERIES, name, QUERIES[name])
    monkeypatch.setitem(OTHER_ORACLES, name, ORACLES[name])
    assert difference(spark, db, name, FOLDER) is None


COLUMNS = {
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_html_extraction": "page_id url text n_chars",
    "op5_benchmark_decontamination": "doc_id item_id",
    "op8_toxicity": "doc_id held_out score predicted",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_license_scans": "doc_id n_words n_base first_word last_word base_labels labels score",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, FOLDER)
    wanted = COLUMNS[name].split()
    assert found.columns[: len(wanted)] == wanted
    rows = found.collect()
    if name.startswith(("op8", "op9", "op10")):
        assert len(rows) == table(spark, FOLDER, "documents").count()
    if name.startswith("op4"):
        # The number in a page's path is its document; lines of that make the paragraphs.
        texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
        for r in rows:
            number = int(re.search(r"/(\d+)[^/]*/?$", re.sub(r"[?#].*", "", r.url))[1])
            lines = [" ".join(x.split()) for x in texts[number].split("\n") if x.split()]
            assert r.text.split("\n")[1:] == lines
    if name.startswith("op5"):
        items = {r.item_id: r.text for r in table(spark, FOLDER, "benchmark").collect()}
        texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
        verbatim = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
        assert {(r.doc_id, r.item_id) for r in rows if r.distance == 0} >= verbatim


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}

    def kept(text):
        m = helpers.measures(text)
        n, lines = m["n_words"], [x for x in (text or "").split("\n") if x.strip(quality_rules.BLANK)]
        capitals = len(re.findall("[A-Z]", text or ""))
        return not (
            n < 10 or 100 * m["n_repeat_words"] > 20 * n or 100 * m["n_symbols"] > 40 * n
            or 100 * m["n_dup_lines"] > 50 * len(lines) or m["word_chars"] < 2 * n
            or m["word_chars"] > 25 * n or 100 * capitals > 60 * m["word_chars"]
        )

    left = {i: t for i, t in texts.items() if kept(t)}
    found = helpers.components(list(left.items()), corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY)
    left = {i: t for i, t in left.items() if found[i][1] == i}
    shortened = {}
    for i, (words, gone) in helpers.repeats(list(left.items())).items():
        runs = "".join("x" if g else " " for g in gone)
        for run in re.finditer("x+", runs):
            if len(run[0]) < corpus_pipeline.REPEAT_WORDS:
                gone[run.start() : run.end()] = [False] * len(run[0])
        rest = [w for w, g in zip(words, gone) if not g]
        if rest or not words:
            shortened[i] = " ".join(rest) if any(gone) else left[i]
    items = [r.text.lower() for r in table(spark, FOLDER, "benchmark").collect()]
    plain = {i: " ".join(helpers.words(t)).lower() for i, t in shortened.items()}
    stages, names = docs, docs.columns
    for n, (_, build) in enumerate(corpus_pipeline.STAGES[:-1]):
        stages = build(spark, stages, FOLDER)
        assert stages.columns == names
        if n == 2:
            assert {r.doc_id: r.text for r in stages.collect()} == shortened
    clean = {r.doc_id: r.text for r in stages.collect()}
    assert clean == {i: t for i, t in shortened.items() if i in clean}
    for i in shortened:
        if i in clean:
            assert not any(x in plain[i] for x in items)
        else:
            assert any(
                helpers.edit_distance_inside(x, plain[i]) <= decontaminate.RATE * len(x) for x in items
            )
    by_doc = defaultdict(int)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        by_doc[r.doc_id] += r.length
    assert set(by_doc) == set(clean)
    packed = packing.pack(stages, tokenizer_path(), with_ids=True).collect()
    check_packed(packed, clean, packing.LENGTH)


def _prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8))) for _ in range(n))


def test_every_stage_takes_odd_tables(spark, tmp_path):
    """NULL ids and texts, rows that share an id, equal rows, very long texts, clashing columns, no rows."""
    item = "this very item of a benchmark must not be seen by anyone at all"
    texts = [
        (1, _prose(1, 80)), (1, _prose(2, 80)), (2, _prose(3, 60)), (2, _prose(3, 60)), (3, _prose(1, 80)),
        (None, _prose(4, 70)), (None, _prose(4, 70)), (4, None), (5, ""), (6, " \n"), (7, _prose(5, 60_000)),
        (8, f"{_prose(6, 30)} {item} {_prose(7, 30)}"), (9, _prose(8, 12)),
    ]
    clash = {n: F.lit(f"own {n}") for n in (
        "row", "words", "kept_id", "component_id", "n", "key", "start", "length", "failed_bits", "anchor", "ids",
    )}
    docs = helpers.docs(spark, texts).withColumns(clash)
    spark.createDataFrame([(1, item), (None, "x"), (2, None)], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    for table_, n in ((docs, len(texts)), (docs.limit(0), 0)):
        for name, build in corpus_pipeline.STAGES:
            # Each stage by itself takes them all.
            found = build(spark, table_, str(tmp_path))
            rows = found.collect()
            if name == "packing":
                assert sum(r.start == 0 for r in rows) == n
                continue
            assert found.columns == table_.columns
            assert all(r[c] == f"own {c}" for r in rows for c in clash)
            own = [(r.doc_id, r.text) for r in rows]
            if not n:
                assert own == []
            elif name == "quality_rules":
                assert own and {i for i, _ in own} <= {1, 2, 3, None, 7, 8, 9} and own.count((None, _prose(4, 70))) == 2
            elif name == "ngram_jaccard_join":
                # Document 3 is a copy of a row of document 1.
                assert sorted(map(repr, own)) == sorted(repr(t) for t in texts if t[0] != 3)
            elif name == "substring_dedup":
                # The same words in a later document go, and with them a document of nothing else.
                assert 3 not in {i for i, _ in own} and (4, None) in own and (7, _prose(5, 60_000)) in own
            else:
                assert sorted(map(repr, own)) == sorted(repr(t) for t in texts if t[0] != 8)
    docs = docs.where("true")
    for _, build in corpus_pipeline.STAGES:
        docs = build(spark, docs, str(tmp_path))
    assert {r.doc_id for r in docs.collect()} == {1, 2, None, 7, 9}
