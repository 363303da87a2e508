"""Quality rules as a bitmask ledger (operator 4, native).

Every rule is evaluated once per document. The ledger keeps what was measured
and one failure bit per rule; a policy is a named set of rules, so applying a
policy, comparing two versions or asking what a rule alone removes are bitwise
operations on the stored bits, without reading a text again. Ablations first
count the distinct bit patterns (at most 2 to the number of rules), then
aggregate those.

Measurements: n_words; word_chars (code points in words); n_symbols
(characters of ``#*$%&|<>``); n_lines (lines with a word); n_dup_lines (of
those, lines equal to an earlier line); n_repeat_words (words in 8-word
windows that stand in the text twice or more); n_same_words (words equal to
the word before); n_upper (upper-case letters).

Repeated windows are found per row from sorted window hashes, and only in
texts that have any, so nothing but the ledger row leaves a task.

Defined cases: a null, empty or blank text measures 0 everywhere and fails
``few_words``; repeated rows are judged alike; an empty table gives no rows.
Columns other than id and text are only carried by ``apply_policy``.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import BLANKS, WORD, rows_as_struct

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_words", "n_upper")

#: Rules in bit order: name and the condition under which a document fails. New rules go at the end.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    ("same_words", "100 * n_same_words > 30 * n_words"),
    ("upper_case", "100 * n_upper > 50 * word_chars"),
)
#: Versioned policies: the rules that reject a document.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length", "same_words", "upper_case"),
}
CURRENT_POLICY = "v2"


def rule_bit(name: str) -> int:
    return 1 << [r for r, _ in RULES].index(name)


def policy_mask(policy: str) -> int:
    return reduce(lambda a, b: a | b, (rule_bit(r) for r in POLICIES[policy]))


def fails(policy: str, bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(policy_mask(policy)).cast("bigint")) != 0


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def measures(rows: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns and every measurement of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = rows.select(
        *keep,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: _without(line, BLANKS) > 0).alias("_lines"),
        _without(text, BLANKS).alias("word_chars"),
        (F.char_length(text) - _without(text, SYMBOLS)).alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"),
    )
    kept = [*keep, "word_chars", "n_symbols", "n_upper"]
    step = step.select(
        *kept,
        F.size("_words").alias("n_words"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    step = step.select(*kept, "_h", _pairs("_h", 1).alias("_h2"))
    same = F.zip_with("_h", F.slice("_h", 2, F.greatest(F.size("_h") - 1, F.lit(0))), lambda a, b: a == b)
    step = step.select(*kept, F.size(F.filter(same, lambda x: x)).alias("n_same_words"), "_h2")
    kept += ["n_same_words"]
    step = step.select(*kept, _pairs("_h2", 2).alias("_h4"))
    step = step.select(*kept, _pairs("_h4", 4).alias("_h8"))  # hashes of all 8-word windows
    # (hash, place) in order of hash, only where some window repeats
    step = step.select(
        *kept,
        F.when(
            F.size(F.array_distinct("_h8")) < F.size("_h8"),
            F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_s"),
    )
    twice = lambda e, k: (e["h"] == F.when(k > 0, F.get("_s", k - 1)["h"])) | (e["h"] == F.get("_s", k + 1)["h"])
    places = F.filter(
        F.transform("_s", lambda e, k: F.when(F.coalesce(twice(e, k), F.lit(False)), e["i"])), lambda i: i.isNotNull()
    )
    step = step.select(*kept, F.sort_array(places).alias("_p"))
    # windows start at the places p; together they cover the sum of min(8, gap to the next) and 8 for the last
    gaps = F.zip_with("_p", F.slice("_p", 2, F.greatest(F.size("_p") - 1, F.lit(0))),
                      lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    step = step.select(*kept, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    return step.select(*keep, *[F.col(m).cast("bigint").alias(m) for m in MEASURES])


def _pairs(column: str, step: int) -> Column:
    """Hashes of each element with the one ``step`` further; empty if there is none."""
    n = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(F.slice(column, 1, n), F.slice(column, step + 1, n), lambda a, b: F.xxhash64(a, b))


def failure_bits() -> Column:
    """The ledger's bitmask from the measurement columns: bit i is set if rule i fails."""
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, (_, cond) in enumerate(RULES)]
    # A filter on the bits must stay above the measuring steps: pushed below them, it would repeat each step's
    # expressions in the next one's place, many times over. Spark leaves it above a column that is not deterministic.
    stay = F.monotonically_increasing_id().bitwiseAND(F.lit(0).cast("bigint"))
    return reduce(lambda a, b: a.bitwiseOR(b), [*bits, stay])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, every measurement and ``fail_bits``, one row per document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("_text"))
    return measures(rows, "_text", ["doc_id"]).withColumn("fail_bits", failure_bits())


def ablation(rows: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """``rule, n_failed, n_alone, n_kept_without`` per rule of a policy, from a ledger.

    ``n_alone`` documents fail this rule and no other of the policy;
    ``n_kept_without`` is what the policy would keep if it lacked the rule.
    An empty ledger gives a row of zeros for every rule.
    """
    mask = policy_mask(policy)
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    nothing = rows.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("fail_bits"), F.lit(0).cast("bigint").alias("n"))
    patterns = patterns.select(F.col("fail_bits").cast("bigint").alias("fail_bits"), "n").unionByName(nothing)
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("bigint"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(rule_bit(r)).cast("bigint").alias("bit")) for r in POLICIES[policy]]))
    each = patterns.select("n", bits.alias("bits"), rules.alias("r")).select("n", "bits", "r.rule", "r.bit")
    others = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("bit")).alias("n_alone"),
        count(others == 0).alias("n_kept_without"),
    )


def apply_policy(docs: DataFrame, policy: str = CURRENT_POLICY, text_col: str = "text") -> DataFrame:
    """The input rows that the policy keeps, with all their columns."""
    judged = measures(rows_as_struct(docs, [text_col]), f"_{text_col}", ["_row"])
    judged = judged.select("_row", failure_bits().alias("_bits"))
    return judged.filter(~fails(policy, F.col("_bits"))).select("_row.*")
