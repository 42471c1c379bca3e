import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from keelstone.llm.words import Words, distinct_per_text, split_block, text_bytes
from tests.llm.helpers import words

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c  ", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(given_texts):
    found = Words(*text_bytes(pa.array(given_texts, pa.string())))
    got = [
        [found.data[a:b].tobytes().decode() for a, b in zip(found.start[x:y], found.end[x:y])]
        for x, y in zip(found.first[:-1], found.first[1:])
    ]
    assert got == [words(t) for t in given_texts]


@settings(max_examples=100, deadline=None)
@given(texts)
def test_grams_are_equal_exactly_for_equal_words(given_texts):
    found = Words(*text_bytes(pa.array(given_texts, pa.string())))
    gram, first = found.grams(2)
    spelled = [w for t in given_texts for w in words(t)]
    owner = found.text_of()
    assert [int(i) for i in first] == [
        i for i in range(len(spelled) - 1) if owner[i] == owner[i + 1]
    ]
    pairs = [(spelled[i], spelled[i + 1]) for i in first]
    assert len(set(gram.tolist())) == len(set(pairs))


def test_long_words_are_told_apart():
    long = ["x" * 70 + "a", "x" * 70 + "b", "x" * 64, "x" * 65, "y" * 8, "y" * 16]
    h = Words(*text_bytes(pa.array([" ".join(long)]))).hashes()
    assert len(set(h.tolist())) == len(long)


def test_slices_and_nulls():
    column = pa.array(["a b", None, "", "c"])
    found = Words(*text_bytes(column.slice(1)))
    assert found.counts.tolist() == [0, 0, 1]
    assert Words(*text_bytes(pa.array([], pa.string()))).counts.tolist() == []


def test_blocks_cover_all_rows_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (3, 0, 9, 1, 1, 20, 2)])], ["t"])
    sizes = [len(b) for b in split_block(batch, "t", 10)]
    assert sum(sizes) == 7 and min(sizes) >= 1
    joined = [x for b in split_block(batch, "t", 10) for x in b.column(0).to_pylist()]
    assert joined == batch.column(0).to_pylist()


def test_distinct_per_text():
    values = np.array([3, 1, 3, 7, 7, 3], dtype=np.uint64)
    got, n = distinct_per_text(np.array([3, 0, 2, 1]), values)
    assert got.tolist() == [1, 3, 7, 3] and n.tolist() == [2, 0, 1, 1]
