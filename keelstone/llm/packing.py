"""Cost-balanced packing of documents into sequences.

The cost of a piece of n tokens is estimated as `linear * n + quadratic * n * n`:
the second term is its attention, which stays inside a piece. Documents are cut
into full sequences and a rest; the rests of a block, in descending order, go
to the sequence of lowest cost that has room. The number of sequences of a
block is the least that holds its tokens; when no sequence has room for a whole
rest, it is cut to fill the emptiest ones, so all sequences of a block but one
are full.

Blocks follow the rows of a task and hold a bounded number of tokens, so tasks
need no shuffle, no more memory with more data, and a rerun of a lost task
gives the same sequences. A block leaves less than one sequence of padding.

Defined cases: a NULL or empty text is its end-of-document token alone. Equal
rows and equal ids are packed row by row. Extra columns are ignored; an empty
table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from keelstone.llm.words import Words, split_block, text_bytes

LENGTH = 2048
BLOCK_TOKENS = 2048 * LENGTH
END_ID = 1
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
CACHED_WORDS = 1_000_000
TEXT_BLOCK_BYTES = 2 * 1024 * 1024

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


# Words of Latin letters, then perhaps marks: their pre-tokens are the letters and the marks.
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,;:!?]*)")


def _byte_letters() -> list[str]:
    """Letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 up."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordTokens:
    """Token ids by word, for a byte-level tokenizer that never joins over white space.

    Every distinct word (by its 64-bit hash) is tokenised once. Words of plain Latin letters go
    to the tokenizer's model directly, which skips its text handling; all others, and the marks
    behind words, go through the whole tokenizer. What is known is forgotten when it grows too large.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.stems: dict[str, list[int]] = {}
        self.marks: dict[str, list[int]] = {"": []}

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            return self._encode(word)
        stem, mark = plain[1].lower(), plain[2]
        ids = self.stems.get(stem)
        if ids is None:
            spelled = stem if stem.isascii() else "".join([self.letters[b] for b in stem.encode()])
            ids = self.stems[stem] = [t.id for t in self.model.tokenize(spelled)]
        if not mark:
            return ids
        after = self.marks.get(mark)
        if after is None:
            after = self.marks[mark] = self._encode(mark)
        return ids + after

    def _learn(self, hashes: np.ndarray, spelled: list[bytes]) -> None:
        pieces = [self._word(w.decode("utf-8")) for w in spelled]
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        at = len(self.ids) + np.cumsum(size) - size
        new = np.fromiter(chain.from_iterable(pieces), np.uint32, int(size.sum()))
        self.ids = np.concatenate((self.ids, new))
        merged = np.concatenate((self.hashes, hashes))
        order = np.argsort(merged, kind="stable")
        self.hashes = merged[order]
        self.at = np.concatenate((self.at, at))[order]
        self.size = np.concatenate((self.size, size))[order]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each), without end-of-document ids."""
        data, begin = text_bytes(texts)
        words = Words(data, begin)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if len(self.hashes) > CACHED_WORDS:
            self._forget()
        distinct, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            spans = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist())
            self._learn(distinct[new], [data[a:b].tobytes() for a, b in spans])
            place = np.searchsorted(self.hashes, distinct)
        n = self.size[place][number]
        ends = np.cumsum(n)
        source = np.repeat(self.at[place][number] - (ends - n), n) + np.arange(ends[-1])
        per_word = np.concatenate(([0], ends))
        return self.ids[source], per_word[words.first[1:]] - per_word[words.first[:-1]]


def _cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def assign(sizes: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of one block."""
    pieces, rests = [], []
    sequence = 0
    for doc, size in enumerate(sizes.tolist()):
        full = size // length
        for i in range(full):
            pieces.append((doc, i * length, length, sequence, 0))
            sequence += 1
        if size % length:
            rests.append((size % length, doc, full * length))
    rests.sort(key=lambda r: (-r[0], r[1]))
    count = -(-sum(r[0] for r in rests) // length)
    cost, room = np.zeros(count), np.full(count, length)
    for size, doc, start in rests:
        left = size
        while left:
            # The cheapest sequence with room for the rest; if there is none, the cheapest to fill up.
            fits = room >= left
            whole = left == size and fits.any()
            i = int(np.where(fits if whole else room > 0, cost, np.inf).argmin())
            n = min(left, int(room[i]))
            pieces.append((doc, start, n, sequence + i, length - int(room[i])))
            cost[i] += _cost(n)
            room[i] -= n
            start += n
            left -= n
    return pieces


def pack(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    length: int = LENGTH, block_tokens: int = BLOCK_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document, see `SCHEMA`; `with_ids` adds the token ids."""
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def flush(docs: list, ids: list, base: int, sequence: int):
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        pieces = assign(sizes, length)
        cut = [ids[d][s : s + n] for d, s, n, _, _ in pieces]
        rows = {
            "doc_id": [docs[p[0]] for p in pieces],
            "start": [p[1] for p in pieces],
            "length": [p[2] for p in pieces],
            "ids_crc32": [zlib.crc32(c.astype("<u4").tobytes()) for c in cut],
            "doc_tokens": [int(sizes[p[0]]) for p in pieces],
            "sequence_id": [base + sequence + p[3] for p in pieces],
            "offset": [p[4] for p in pieces],
        }
        columns = [pa.array(v, pa.int64()) for v in rows.values()]
        names = list(rows)
        if with_ids:
            columns.append(pa.array([c.astype(np.int32) for c in cut], pa.list_(pa.int32())))
            names.append("ids")
        top = max((p[3] for p in pieces), default=-1) + 1
        return pa.RecordBatch.from_arrays(columns, names), sequence + top

    def run(batches):
        words = WordTokens(tokenizer_path)
        # Sequence numbers are apart for every task and block.
        base = TaskContext.get().partitionId() << 32
        docs, ids, total, sequence = [], [], 0, 0
        for batch in batches:
            for block in split_block(batch, "text", TEXT_BLOCK_BYTES):
                flat, sizes = words.of(block.column(1))
                ends = np.cumsum(sizes)
                for doc, a, b in zip(
                    block.column(0).to_pylist(), (ends - sizes).tolist(), ends.tolist()
                ):
                    docs.append(doc)
                    ids.append(np.append(flat[a:b], np.uint32(END_ID)))
                    total += b - a + 1
                if total >= block_tokens:
                    out, sequence = flush(docs, ids, base, sequence)
                    yield out
                    docs, ids, total = [], [], 0
        if docs:
            yield flush(docs, ids, base, sequence)[0]

    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)
