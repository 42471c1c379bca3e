"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, look-alike letters of other scripts and
digits or signs that stand for letters become one letter per look. Terms of the
lexicon are whole words of any length, or beginnings of words of `STEM` letters or
more, which cover inflected forms; they are found by one Aho-Corasick automaton.
A term inside an exception phrase does not count.

The lexicon is learned from labelled rows: terms that occur clearly more often in
toxic documents are candidates (the `candidates` clearest of those found in
`min_share` of them, and in 3 at least), and a logistic regression with a ridge
penalty gives each its weight, so words that merely travel with others get
little. A second regression turns the weighted sum and its value per 100 words into a
score from 0 to 1.

Fitting uses a bounded sample of labelled documents (`rows`, one text per id); scoring
covers all texts. Defined cases: NULL, empty and blank texts have no hit and get the
score of such texts. Without labelled rows of both kinds the score is the share
of toxic ones (0 if there are none). Rows are scored one by one, so repeated
rows get equal scores; labels that repeat an id count once (the largest). Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keelstone.llm.words import Words, map_blocks, text_bytes

SAMPLE_ROWS = 20_000
CANDIDATES = 400
STEM = 4  # letters of the shortest beginning of a word
MIN_SHARE = 0.005  # of the toxic documents
WHOLE = "."  # ends a term that is a whole word
MIN_LOG_ODDS = 1.5
RIDGE = 2.0
THRESHOLD = 0.3

# Letters of one look, the first stands for all of them.
LOOKS = (
    "aаα4@", "bвь8", "cсϲ", "dԁ", "eеєε3", "g9ɡ", "hһ", "iіıιl1ӏ", "jј", "kкκ", "mм", "nոη", "oоοօ0",
    "pрρ", "qԛ", "sѕ5", "tтτ7", "uυս", "vνѵ", "wԝω", "xхχ", "yуγ", "zʐ",
)
# Signs that stand for a letter only where a letter follows.
SIGNS = {"$": "s", "!": "i", "|": "i", "+": "t"}

#: Phrases in which a term has a harmless sense.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "take out the trash",
    "clown fish", "class clown", "rodeo clown", "loser bracket", "losers bracket",
    "scum line", "pond scum", "soap scum", "pathetic fallacy",
    "the idiot by dostoevsky", "useful idiot theory",
)

_FOLD = {ord(c): look[0] for look in LOOKS for c in look}
_SIGN = re.compile(r"[$!|+](?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower-case text with one letter per look; its length stays."""
    lowered = text.lower()
    if len(lowered) != len(text):
        # A few letters become two in lower case.
        lowered = "".join(c.lower()[0] for c in text)
    if any(s in lowered for s in SIGNS):
        lowered = _SIGN.sub(lambda m: SIGNS[m[0]], lowered)
    return lowered.translate(_FOLD)


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)  # folded term -> weight
    # Score: sigmoid(bias + by_sum * sum + by_density * sum per 100 words).
    bias: float = -20.0
    by_sum: float = 0.0
    by_density: float = 0.0


class Matcher:
    """Counts of lexicon terms in folded texts."""

    def __init__(self, terms, exceptions=EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.empty = True
        by_word: dict[str, list[str]] = {}
        for term in terms:
            by_word.setdefault(term.removesuffix(WHOLE), []).append(term)
        for word, own in by_word.items():
            self.automaton.add_word(word, (len(word), own, False))
            self.empty = False
        for phrase in exceptions:
            folded = fold(phrase)
            if folded not in self.automaton:
                self.automaton.add_word(folded, (len(folded), [], True))
        self.automaton.make_automaton()

    def counts(self, text: str) -> dict[str, int]:
        if self.empty:
            return {}
        folded = fold(text)
        found, excused = [], []
        for end, (length, own, exception) in self.automaton.iter(folded):
            begin = end - length + 1
            if begin and folded[begin - 1].isalpha():
                continue
            whole = end + 1 == len(folded) or not folded[end + 1].isalpha()
            if exception:
                if whole:
                    excused.append((begin, end))
            else:
                found += [(begin, end, term) for term in own if whole or not term.endswith(WHOLE)]
        out: dict[str, int] = {}
        for begin, end, term in found:
            if not any(a <= begin and end <= b for a, b in excused):
                out[term] = out.get(term, 0) + 1
        return out


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (the bias last) of a logistic regression with a ridge penalty, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of at most about `rows` labelled documents, chosen by a hash of the id."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    total = known.count()
    if total > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(total)) < rows)
    # The sample is bounded, so it can go to all executors.
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # One text per id, so that the sample stays bounded.
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def _terms(text: str) -> set[str]:
    """The terms that a text has: its words, and their beginnings."""
    words = set(_WORD.findall(fold(text)))
    return {w + WHOLE for w in words} | {w[:n] for w in words for n in range(STEM, len(w) + 1)}


def learn(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, candidates: int = CANDIDATES,
    min_share: float = MIN_SHARE,
) -> Lexicon:
    """Fit a lexicon on labelled rows; `labels` has doc_id and toxic (0 or 1)."""
    sample = _sample(docs, labels, rows)

    def word_counts(batches):
        counts: dict[str, list[int]] = {"": [0, 0]}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[""][toxic] += 1
                for term in _terms(text or ""):
                    counts.setdefault(term, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts), pa.string()),
                pa.array([c[0] for c in counts.values()], pa.int64()),
                pa.array([c[1] for c in counts.values()], pa.int64()),
            ],
            ["term", "n0", "n1"],
        )

    counted = (
        sample.mapInArrow(word_counts, "term string, n0 bigint, n1 bigint")
        .groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    total = counted.where("term = ''").first()
    n0, n1 = (total["n0"], total["n1"]) if total else (0, 0)
    if not n0 or not n1:
        return Lexicon(bias=20.0 if n1 else -20.0)
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (n0 + 1.0))
    likely = (
        counted.where("term <> ''").where(F.col("n1") >= max(3, min_share * n1))
        .select("term", odds.alias("odds"), "n0", "n1").where(F.col("odds") >= MIN_LOG_ODDS)
        .orderBy(F.desc(F.col("odds") * F.sqrt("n1")), F.desc(F.length("term")), "term")
        .limit(8 * candidates).collect()
    )
    # Terms that occur in as many documents as a part of them say the same; the longest stands for them.
    counts = {r["term"]: (r["n0"], r["n1"]) for r in likely}
    longer = {t[:-1] for t, c in counts.items() if counts.get(t[:-1]) == c}
    terms = [r["term"] for r in likely if r["term"] not in longer][:candidates]
    if not terms:
        return Lexicon(bias=float(np.log(n1 / n0)))

    def features(batches):
        matcher = Matcher(terms)
        place = {t: i for i, t in enumerate(terms)}
        for batch in batches:
            found = [matcher.counts(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([[place[t] for t in f] for f in found], pa.list_(pa.int32())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.int32())),
                    pa.array(_n_words(batch.column(0))), batch.column(1),
                ],
                ["at", "n", "n_words", "toxic"],
            )

    rows_ = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        features, "at array<int>, n array<int>, n_words bigint, toxic int"
    ).collect()
    x = np.zeros((len(rows_), len(terms)))
    for i, r in enumerate(rows_):
        x[i, r["at"]] = np.log1p(r["n"])
    y = np.array([r["toxic"] for r in rows_], dtype=float)
    w = logistic(x, y, RIDGE)[:-1]
    kept = w > 0.25
    weights = {t: float(v) for t, v, k in zip(terms, w, kept) if k}
    total_ = x[:, kept] @ w[kept]
    n_words = np.array([r["n_words"] for r in rows_], dtype=float)
    fit = logistic(np.stack((total_, _density(total_, n_words)), axis=1), y, 0.1)
    return Lexicon(weights, float(fit[2]), float(fit[0]), float(fit[1]))


def _n_words(texts: pa.Array) -> np.ndarray:
    return Words(*text_bytes(texts)).counts.astype(np.int64)


def _density(total: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return np.log1p(100 * total / np.maximum(n_words, 1))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score, n_hits) of every row."""

    def work(block):
        matcher = Matcher(lexicon.weights)
        total, n_hits = np.zeros(len(block)), np.zeros(len(block), np.int64)
        for i, text in enumerate(block.column(1).to_pylist()):
            found = matcher.counts(text or "")
            total[i] = sum(lexicon.weights[t] * np.log1p(n) for t, n in found.items())
            n_hits[i] = sum(found.values())
        density = _density(total, _n_words(block.column(1)).astype(float))
        value = _sigmoid(lexicon.bias + lexicon.by_sum * total + lexicon.by_density * density)
        return pa.RecordBatch.from_arrays(
            [block.column(0), pa.array(value), pa.array(n_hits)], ["doc_id", "score", "n_hits"]
        )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return map_blocks(rows, "text", work, "doc_id bigint, score double, n_hits bigint")
