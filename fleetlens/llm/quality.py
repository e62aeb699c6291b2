"""Quality rules as a bitmask ledger (native expressions only).

``ledger`` evaluates every rule once per document and keeps the measurements
and one failure bit per rule. A policy is a versioned set of rules, so
``apply_policy`` and ``ablations`` work on the bits alone and never read a
text again.

Rows: null text counts as empty (no words: the too-short rule fails); null or
repeated ids are kept row by row; an empty table gives an empty ledger; input
columns other than the id and the text are ignored, so none can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, pick

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8

# name -> condition under which a document fails, over the measurement
# columns. The position in this list is the rule's bit; append only.
RULES: list[tuple[str, Column | str]] = [
    ("too_few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "10 * n_symbols > word_chars"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("many_symbols_per_word", "2 * n_symbols > n_words"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document that fails one is rejected."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[r] for r in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_words"))
V1 = Policy("v1", BASE.rules + ("short_words", "long_words", "symbols", "repeated_lines"))
V2 = Policy("v2", V1.rules + ("many_symbols_per_word",))
POLICIES = (BASE, V1, V2)


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and the measurements every rule uses."""
    ws = r"[\x20\x09-\x0D]+"
    base = pick(df, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    trimmed = F.btrim("text", F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, ws))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    split = base.select(
        "doc_id",
        F.transform(words, lambda w: F.xxhash64(w)).alias("wh"),
        F.length(F.regexp_replace("text", ws, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(lines)).cast("long").alias("_distinct_lines"),
    )
    # Hashes of 8-word windows by doubling: pairs, fours, eights. Every window
    # is hashed once, whatever the text's length.
    for step, src, dst in ((1, "wh", "h2"), (2, "h2", "h4"), (4, "h4", "h8")):
        n = F.size(src) - F.lit(step)
        joined = F.zip_with(
            F.slice(src, F.lit(1), n), F.slice(src, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b)
        )
        keep = ["doc_id", "word_chars", "n_symbols", "n_lines", "_distinct_lines"]
        n_col = [F.size("wh").cast("long").alias("n_words")] if src == "wh" else ["n_words"]
        split = split.select(
            *keep, *n_col, F.when(n > 0, joined).otherwise(F.array().cast("array<bigint>")).alias(dst)
        )
    some = F.size(F.array_distinct("h8")) < F.size("h8")
    tagged = F.array_sort(F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    measured = ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines"]
    dup_lines = (F.col("n_lines") - F.col("_distinct_lines")).alias("n_dup_lines")
    return split.select(*measured, dup_lines, F.when(some, tagged).alias("tagged")).select(
        *measured,
        "n_dup_lines",
        F.coalesce(_covered("tagged"), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _covered(tagged: str) -> Column:
    """Words inside windows that occur twice or more.

    ``tagged`` holds (hash, position) in order. Equal hashes are neighbours;
    their positions, back in text order, each add the words of their window
    that the one before did not cover. Null where no window repeats.
    """
    n = F.size(tagged)
    gap = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    beside = F.arrays_zip(
        F.col(tagged).alias("own"),
        F.concat(gap, F.slice(tagged, F.lit(1), n - 1)).alias("before"),
        F.concat(F.slice(tagged, F.lit(2), n - 1), gap).alias("after"),
    )
    twice = F.filter(
        beside,
        lambda x: x["own"]["h"].eqNullSafe(x["before"]["h"]) | x["own"]["h"].eqNullSafe(x["after"]["h"]),
    )
    at = F.sort_array(F.transform(twice, lambda x: x["own"]["i"]))
    return F.aggregate(
        at,
        F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW_WORDS).alias("last")),
        lambda acc, p: F.struct(
            (acc["sum"] + F.least(F.lit(WINDOW_WORDS), p - acc["last"])).alias("sum"),
            p.alias("last"),
        ),
        lambda acc: acc["sum"],
    )


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set if rule i fails."""
    bits = F.lit(0).cast("long")
    for i, (_, cond) in enumerate(RULES):
        bits = bits + F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return measure(df, id_col, text_col).withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    return led.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(led: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: documents that fail the rule, that fail no other
    rule of the policy (what dropping it would let in), and that pass all.

    One aggregation over the ledger, bits only; (policies x rules) rows.
    """
    bits = F.col("fail_bits")
    grid = [(p, r) for p in policies for r in p.rules]
    sums = []
    for k, (p, r) in enumerate(grid):
        inside = bits.bitwiseAND(F.lit(p.mask))
        one = F.lit(1 << BIT[r])
        sums += [
            F.count_if(inside.bitwiseAND(one) != 0).alias(f"f{k}"),
            F.count_if(inside == one).alias(f"o{k}"),
            F.count_if(inside == 0).alias(f"k{k}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(p.version).alias("policy"),
                F.lit(r).alias("rule"),
                F.col(f"f{k}").alias("failed"),
                F.col(f"o{k}").alias("failed_only_this"),
                F.col(f"k{k}").alias("kept"),
            )
            for k, (p, r) in enumerate(grid)
        ]
    )
    return led.agg(*sums).select(F.inline(rows))


def quality_digest(df: DataFrame, policy: Policy = V2) -> DataFrame:
    """The contract's columns, with the ledger's bits for audit."""
    led = apply_policy(apply_policy(ledger(df), BASE, "base_ok"), policy)
    return led.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~F.col("base_ok")).alias("base_failed"),
        "kept",
        "fail_bits",
    )
