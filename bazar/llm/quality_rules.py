"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps what was measured and one failure bit per
rule. Which failures reject a document is said by a policy, a named mask over the bits, so a new policy
or the question what a rule costs needs no second look at the texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from bazar.llm.tables import with_text_columns
from bazar.llm.text import WORD_BYTES, content_hashes, covered, group_sums, window_hashes, window_starts, word_spans

REPEAT_WINDOW = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_WORD_CHARS = WORD_BYTES.copy()
_WORD_CHARS[0x80:0xC0] = False  # continuation bytes
_NOT_LINE_FEED = np.ones(256, bool)
_NOT_LINE_FEED[0x0A] = False

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns of ``MEASURES`` for the rows of a piece."""
    rows = len(offsets) - 1
    starts, ends, bounds = word_spans(data, offsets)
    n_words = np.diff(bounds)
    word_chars = group_sums(_WORD_CHARS[data], offsets)
    n_symbols = group_sums(_SYMBOLS[data], offsets)

    # lines with a word, by their content; a line without one cannot count
    opens, closes, lines = word_spans(data, offsets, _NOT_LINE_FEED)
    owner = np.repeat(np.arange(rows), np.diff(lines))
    worded = np.searchsorted(starts, closes) > np.searchsorted(starts, opens)
    opens, closes, owner = opens[worded], closes[worded], owner[worded]
    n_lines = np.bincount(owner, minlength=rows)
    hashes = content_hashes(data, opens, closes)
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(order), bool)
    again[1:] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    n_dup_lines = np.bincount(owner[order[again]], minlength=rows)

    # words in windows that occur more than once in their text
    windows = window_starts(bounds, REPEAT_WINDOW)
    hashes = window_hashes(content_hashes(data, starts, ends), REPEAT_WINDOW)
    hashes = hashes[windows] if len(windows) else hashes[:0]
    owner = np.searchsorted(bounds, windows, side="right") - 1
    order = np.lexsort((hashes, owner))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    twice = windows[order[same[1:] | same[:-1]]]
    n_repeat_words = group_sums(covered(twice, REPEAT_WINDOW, len(starts)), bounds)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines]


# Bit i of failure_bits is rule i. Rules are only ever added at the end, so stored ledgers keep their meaning.
RULE_NAMES = ["too_few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words", "many_repeated_lines"]


def _rules() -> dict[str, Column]:
    words = F.col("n_words")
    repeated_lines = 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")
    return {
        "too_few_words": words < 20,
        "repeated_windows": 100 * F.col("n_repeat_words") > 30 * words,
        "symbols": 100 * F.col("n_symbols") > 10 * F.col("word_chars"),
        "repeated_lines": repeated_lines,
        "short_words": F.col("word_chars") < 2 * words,
        "long_words": F.col("word_chars") > 25 * words,
        # one line twice in a short text says little
        "many_repeated_lines": (F.col("n_dup_lines") >= 3) & repeated_lines,
    }


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails any of ``rules``, or ``at_least`` of ``votes``."""

    version: str
    rules: Sequence[str]
    votes: Sequence[str] = field(default=())
    at_least: int = 2

    @staticmethod
    def mask(rules: Sequence[str]) -> int:
        return sum(1 << RULE_NAMES.index(name) for name in rules)


POLICIES = {
    p.version: p
    for p in (
        Policy("base", ["too_few_words", "repeated_windows"]),
        Policy("2024-1", ["too_few_words", "repeated_windows", "symbols", "repeated_lines"]),
        Policy("2024-2", ["too_few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words"]),
        Policy("2024-3", ["too_few_words", "repeated_windows", "symbols", "many_repeated_lines", "short_words", "long_words"]),
    )
}
CURRENT = "2024-3"


def ledger(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add the measures and ``failure_bits``, all long, to every row; the texts are read once.

    A NULL or empty text has no words and fails ``too_few_words`` alone. Rows are independent, so repeated
    rows get equal entries and an empty table an empty ledger. Columns called like the new ones are replaced.
    """
    measured = with_text_columns(docs, text, [StructField(name, LongType()) for name in MEASURES], measure, keep)
    rules = _rules()
    bits = sum((F.when(rules[name], F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(RULE_NAMES)), F.lit(0))
    return measured.withColumn("failure_bits", bits.cast("bigint"))


def fails(policy: Policy, bits: str = "failure_bits") -> Column:
    failed = F.col(bits).bitwiseAND(F.lit(Policy.mask(policy.rules))) != 0
    if policy.votes:
        failed = failed | (F.bit_count(F.col(bits).bitwiseAND(F.lit(Policy.mask(policy.votes)))) >= policy.at_least)
    return failed


def ablation(entries: DataFrame, policies: Mapping[str, Policy] = POLICIES) -> DataFrame:
    """What each rule of each policy costs, from the bits alone: one row per (version, rule).

    ``n_failed`` documents fail the rule, ``n_only`` are rejected by it alone and would be kept without it,
    ``n_rejected`` are rejected by the policy. The bits are first counted per distinct value, at most one
    for each set of rules, so the table of documents is aggregated once. No rows give zero counts.
    """
    spark = entries.sparkSession
    counted = entries.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    questions = []
    for policy in policies.values():
        for rule in (r for r in RULE_NAMES if r in (*policy.rules, *policy.votes)):
            rest = Policy("", [r for r in policy.rules if r != rule], [r for r in policy.votes if r != rule], policy.at_least)
            bit = F.col("failure_bits").bitwiseAND(F.lit(1 << RULE_NAMES.index(rule))) != 0
            questions.append((policy.version, rule, bit, fails(policy), fails(rest)))
    number = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    sums = [
        F.struct(F.lit(version).alias("version"), F.lit(rule).alias("rule"), number(bit).alias("n_failed"), number(bit & now & ~then).alias("n_only"), number(now).alias("n_rejected"))
        for version, rule, bit, now, then in questions
    ]
    if not sums:
        return spark.createDataFrame([], "version string, rule string, n_failed bigint, n_only bigint, n_rejected bigint")
    return counted.agg(F.array(*sums).alias("rows")).select(F.inline("rows"))


def kept_documents(docs: DataFrame, policy: Policy = POLICIES[CURRENT], text: str = "text") -> DataFrame:
    """The rows the policy does not reject, with their own columns unchanged."""
    columns = docs.columns
    return ledger(docs.select(F.struct(*columns).alias("__row"), F.col(text).alias("__text")), "__text", keep=["__row"]).filter(~fails(policy)).select("__row.*")
