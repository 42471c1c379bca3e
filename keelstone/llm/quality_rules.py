"""Quality rules kept in a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements
and one bit per failed rule; policies are versioned lists of rules applied to
the bits later, and ablations are bitwise aggregates over the distinct bit
patterns, so neither reads a text again.

Defined cases: a NULL, empty or blank text has zero measurements and fails
`few_words`. Repeated rows and ids are judged row by row. The ledger has no other
columns of the input; `keep_good` keeps all of them as they are. An empty table
gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keelstone.llm.words import Words, map_blocks, mix, text_bytes

SYMBOLS = "#*$%&|<>"
WINDOW = 5
BLANK = " \t\n\v\f\r"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"
)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """Measurements of every text of one block."""
    data, at = text_bytes(texts)
    words = Words(data, at)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS.encode())] = True
    capital = np.zeros(256, dtype=bool)
    capital[ord("A") : ord("Z") + 1] = True
    n_lines = np.zeros(len(texts), dtype=np.int64)
    n_dup = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts.to_pylist()):
        lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
        n_lines[i] = len(lines)
        n_dup[i] = len(lines) - len(set(lines))
    return {
        "n_words": words.counts.astype(np.int64),
        # A code point starts at every byte that does not continue one.
        "word_chars": words.per_text(words.inside & ((data & 0xC0) != 0x80)),
        "n_symbols": words.per_text(symbol[data]),
        "n_lines": n_lines,
        "n_dup_lines": n_dup,
        "n_repeat_words": repeated_words(words),
        "n_capitals": words.per_text(capital[data]),
    }


def repeated_words(words: Words, k: int = WINDOW) -> np.ndarray:
    """Words of each text inside a `k`-word window that the text has more than once."""
    gram, at = words.grams(k)
    text = words.text_of()
    key = mix(gram ^ mix(text[at].astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    depth = np.zeros(len(words) + k + 1, dtype=np.int64)
    np.add.at(depth, at[twice], 1)
    np.add.at(depth, at[twice] + k, -1)
    covered = np.cumsum(depth)[: len(words)] > 0
    total = np.concatenate(([0], np.cumsum(covered)))
    return total[words.first[1:]] - total[words.first[:-1]]


@dataclass(frozen=True)
class Rule:
    """A rule fails where `failed` is true of the measurements (arrays by name)."""

    name: str
    failed: Callable[[Mapping[str, np.ndarray]], np.ndarray]


#: The order gives the bit of a rule and is never changed; new rules go to the end.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda m: m["n_words"] < 10),
    Rule("repeats", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    Rule("symbols", lambda m: 100 * m["n_symbols"] > 40 * m["n_words"]),
    Rule("dup_lines", lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
    Rule("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 25 * m["n_words"]),
    Rule(
        "shouting",
        lambda m: (m["n_words"] >= 10) & (100 * m["n_capitals"] > 60 * m["word_chars"]),
    ),
    Rule("some_symbols", lambda m: 100 * m["n_symbols"] > 20 * m["n_words"]),
)

#: A policy rejects what fails any of its rules. Published versions stay as they are.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeats"),
    "v1": ("few_words", "repeats", "symbols", "dup_lines", "short_words", "long_words", "shouting"),
    "v2": (
        "few_words", "repeats", "symbols", "dup_lines", "short_words", "long_words", "shouting",
        "some_symbols",
    ),
}
PRODUCTION_POLICY = "v1"


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    known = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(known[n] for n in set(names))


def failed_bits(found: Mapping[str, np.ndarray], rules: Sequence[Rule] = RULES) -> np.ndarray:
    """Bit i of a row is set if it fails rule i."""
    bits = np.zeros(len(found["n_words"]), dtype=np.int64)
    for i, rule in enumerate(rules):
        bits |= rule.failed(found).astype(np.int64) << i
    return bits


def ledger(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per input row: its id, the measurements and `failed_bits`."""
    names = [id_col, *MEASURES, "failed_bits"]

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(block.column(1))
        columns = [block.column(0), *(pa.array(found[m]) for m in MEASURES)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(failed_bits(found, rules))], names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in names[1:])
    return map_blocks(df.select(id_col, text_col), text_col, work, schema)


def passes(policy: str = PRODUCTION_POLICY, bits: str = "failed_bits") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def apply_policies(rows: DataFrame, policies: Sequence[str]) -> DataFrame:
    """Add one boolean column `kept_<policy>` per policy; no rule is evaluated again."""
    return rows.withColumns({f"kept_{p}": passes(p) for p in policies})


def ablations(rows: DataFrame, policy: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule of a policy does, from the counts of the distinct bit patterns.

    n_failed: rows that fail it; n_only: rows that only it rejects, which a
    policy without the rule would keep.
    """
    named = mask(POLICIES[policy])
    patterns = rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    inside = F.col("failed_bits").bitwiseAND(F.lit(named))
    per_rule = F.explode(
        F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
            for i, r in enumerate(rules)
            if r.name in POLICIES[policy]
        ])
    ).alias("r")
    return (
        patterns.select("n", inside.alias("inside"), per_rule)
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("inside").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0))
            .alias("n_failed"),
            F.sum(F.when(F.col("inside") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def keep_good(df: DataFrame, policy: str = PRODUCTION_POLICY) -> DataFrame:
    """Rows of a documents table that pass the policy, with their own columns.

    The verdict is made where the text is, so no join on the id is needed and
    rows with equal ids are judged apart.
    """
    place, rejecting = df.columns.index("text"), mask(POLICIES[policy])

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        bits = failed_bits(measure(block.column(place)))
        return block.filter(pa.array((bits & rejecting) == 0))

    return map_blocks(df, "text", work, df.schema)
