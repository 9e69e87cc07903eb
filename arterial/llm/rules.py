"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations work on the stored bits.

``ledger`` stores, per document, the measurements and one long with bit i set if rule i failed. A policy is a version
name and the rules that reject; applying another version, or asking what a rule costs, is bit arithmetic on the ledger
and never touches a text again. DataFrame functions only.

Defined cases: null and empty texts measure 0 everywhere (and fail ``few_words``); a ratio with denominator 0 passes;
repeated rows are judged one by one; columns named like results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = "\t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_long_words",
)

def _rules() -> dict[str, Column]:
    """name -> failed; the position is the bit, so stored ledgers stay readable as long as rules are only appended."""
    words, c = F.col("n_words"), F.col
    return {
        "few_words": words < 50,
        "repeated_words": 100 * c("n_repeat_words") > 50 * words,
        "many_words": words > 10_000_000,
        "short_words": 2 * c("word_chars") < 4 * words,
        "long_words": c("word_chars") > 15 * words,
        "symbols": 100 * c("n_symbols") > 10 * words,
        "repeated_lines": 100 * c("n_dup_lines") > 30 * c("n_lines"),
        "few_letters": 100 * c("n_letters") < 60 * c("word_chars"),
        "upper_case": 100 * c("n_upper") > 60 * c("n_letters"),
        "unbroken": 100 * c("n_long_words") > 5 * words,
    }


RULE_NAMES = (
    "few_words", "repeated_words", "many_words", "short_words", "long_words", "symbols", "repeated_lines", "few_letters",
    "upper_case", "unbroken",
)
BASE = ("few_words", "repeated_words")
# versions of the policy: the rules that reject
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "few_letters", "upper_case"),
    "v3": (*BASE, "symbols", "repeated_lines", "few_letters", "upper_case", "short_words", "long_words", "unbroken"),
}
CURRENT = "v3"


def mask(rules: Iterable[str]) -> int:
    return sum(1 << RULE_NAMES.index(rule) for rule in set(rules))


def ledger(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` (columns ``keep``, default all) with the measurements and ``failed_bits``. No shuffle, no Python.

    Repeated three-word windows are found by sorting the windows of one text, so a text costs n log n and nothing is
    kept between texts.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*MEASURES, "failed_bits")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    # every white-space character becomes a space; words are what stands between spaces
    # other columns travel in one struct, so that their names can be anything
    step = docs.select(F.struct(*keep).alias("_row"), text.alias("_text"))
    step = step.select(
        "_row", "_text",
        F.array_remove(F.split(F.translate("_text", _SPACE, " " * len(_SPACE)), " "), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: F.length(F.trim(F.translate(line, _SPACE, " " * len(_SPACE)))) > 0).alias("_lines"),
    )
    long = lambda value: value.cast("bigint")
    step = step.select(
        "_row", "_words",
        long(F.size("_words")).alias("n_words"),
        long(F.length(F.translate("_text", _SPACE + " ", ""))).alias("word_chars"),
        long(F.length("_text") - F.length(F.translate("_text", _SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.length(F.regexp_replace("_text", "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", ""))).alias("n_letters"),
        long(F.length(F.regexp_replace("_text", "[^A-Z]+", ""))).alias("n_upper"),
        long(F.size(F.filter("_words", lambda w: F.length(w) > 40))).alias("n_long_words"),
        # windows with their place, in order of their text
        F.when(F.size("_words") < 3, F.array().cast("array<struct<w:string,i:int>>")).otherwise(
            F.sort_array(F.transform(
                F.slice("_words", 1, F.greatest(F.size("_words") - 2, F.lit(0))),
                lambda w, i: F.struct(F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("w"), i.alias("i")),
            ))
        ).alias("_windows"),
    )
    same = lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))
    step = step.withColumn(
        "_places",
        F.sort_array(F.transform(
            F.filter("_windows", lambda x, i: same(x, F.get("_windows", i - 1)) | same(x, F.get("_windows", i + 1))), lambda x: x["i"]
        )),
    )
    # a repeated window covers three words, or as many as there are up to the next one
    covered = F.aggregate(
        F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, b: a + b,
    )
    step = step.withColumn("n_repeat_words", long(covered)).select("_row.*", *MEASURES)
    bits = F.lit(0).cast("bigint")
    for i, (_, failed) in enumerate(_rules().items()):
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return step.withColumn("failed_bits", bits)


def apply_policy(judged: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with base_failed, kept, and sole_rule: the one rule without which the document would be kept."""
    hit = F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[version])).cast("bigint"))
    sole = F.when(F.bit_count(hit) == 1, F.element_at(F.array(*map(F.lit, RULE_NAMES)), (F.log2(hit.cast("double")) + 1).cast("int")))
    return judged.select(
        *[c for c in judged.columns if c not in ("base_failed", "kept", "sole_rule", "policy")],
        (F.col("failed_bits").bitwiseAND(F.lit(mask(BASE)).cast("bigint")) != 0).alias("base_failed"),
        (hit.bitwiseOR(F.col("failed_bits").bitwiseAND(F.lit(mask(BASE)).cast("bigint"))) == 0).alias("kept"),
        sole.alias("sole_rule"),
        F.lit(version).alias("policy"),
    )


def ablation(judged: DataFrame, version: str = CURRENT) -> DataFrame:
    """(rule, failed, only_this, kept_without): per rule of a policy, how many documents fail it, fail nothing else, and
    would be kept without it. One aggregation over distinct bit patterns, whose number is bounded by the rules."""
    policy = mask(POLICIES[version])
    patterns = judged.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy).cast("bigint")).alias("hit")).agg(F.count(F.lit(1)).alias("n"))
    names = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULE_NAMES.index(r)).cast("bigint").alias("bit")) for r in POLICIES[version]]))
    spread = patterns.select("hit", "n", names.alias("r")).select("hit", "n", "r.rule", "r.bit")
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return spread.groupBy("rule").agg(
        count(F.col("hit").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count(F.col("hit") == F.col("bit")).alias("only_this"),
        count(F.col("hit").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )
