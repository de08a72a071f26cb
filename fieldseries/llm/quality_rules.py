"""Quality rules as a bitmask ledger.

Every rule is evaluated once a document; the ledger keeps its measurements and one failure bit
a rule.  A policy is a version number with the set of bits that reject and a number of lesser
failures that reject together; applying a policy, or the ablation of each rule in it, is then
arithmetic on the ledger and never touches the texts again.

Built-in expressions only.  A document's 3-word windows are compared inside its own row by
sorting (window hash, position) pairs, so nothing is exploded or shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

#: Bit -> (name, condition over the measurements).  Bits 0 and 1 make base_failed.
RULES: dict[int, tuple[str, str]] = {
    0: ("too_few_words", "n_words < 50"),
    1: ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    2: ("symbols", "10 * n_symbols > n_words"),
    3: ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    4: ("short_words", "2 * n_words > word_chars"),
    5: ("long_words", "word_chars > 14 * n_words"),
    6: ("upper_case", "10 * n_upper > 4 * word_chars"),
    7: ("few_letters", "10 * n_letters < 5 * word_chars"),
}


@dataclass(frozen=True)
class Policy:
    """Rejects on any bit of `hard`, or on at least `soft_limit` of the bits of `soft`."""

    version: int
    hard: int
    soft: int = 0
    soft_limit: int = 2
    notes: str = field(default="", compare=False)


POLICIES = {
    1: Policy(1, hard=0b11, notes="base rules only"),
    2: Policy(2, hard=0b01000111, soft=0b10111000, soft_limit=2, notes="base rules, symbols and shouting; two of the rest"),
}


def _repeat_words() -> Column:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = F.size("_w")
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.cast("int").alias("p")),
    )
    return F.when(n >= 3, F.sort_array(windows)).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of docs: its id and measurements.  A null text is empty; other columns are left out."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    d = d.withColumn("_w", F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    d = d.withColumn("_j", F.array_join("_w", ""))
    # lines that hold a word, and the distinct ones among them
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("_s", _repeat_words())
    same = lambda i: (F.get("_s", i)["h"] == F.get("_s", i - 1)["h"]) | F.coalesce(F.get("_s", i)["h"] == F.get("_s", i + 1)["h"], F.lit(False))
    d = d.withColumn("_p", F.array_sort(F.transform(F.filter(F.transform("_s", lambda x, i: F.struct(x["p"].alias("p"), F.coalesce(same(i), F.lit(False)).alias("r"))), lambda x: x["r"]), lambda x: x["p"])))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to")),
        lambda a, p: F.struct((a["n"] + 3 - F.greatest(a["to"] - p, F.lit(0))).cast("bigint").alias("n"), (p + 3).alias("to")),
        lambda a: a["n"],
    )
    long = lambda c: c.cast("bigint")
    return d.select(
        "doc_id",
        long(F.size("_w")).alias("n_words"),
        long(F.length("_j")).alias("word_chars"),
        long(F.length("_j") - F.length(F.translate("_j", "#*$%&|<>", ""))).alias("n_symbols"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        long(F.size("_l")).alias("n_lines"),
        long(F.length("_j") - F.length(F.regexp_replace("_j", r"\p{Lu}+", ""))).alias("n_upper"),
        long(F.length("_j") - F.length(F.regexp_replace("_j", r"\p{L}+", ""))).alias("n_letters"),
    )


def ledger(measured: DataFrame, rules: dict[int, tuple[str, str]] = RULES) -> DataFrame:
    """The measurements with `failures`, a bigint that holds one bit for each failed rule."""
    bits = [F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, condition) in rules.items()]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return measured.withColumn("failures", mask.cast("bigint"))


def rejects(policy: Policy, failures: Column) -> Column:
    hard = failures.bitwiseAND(F.lit(policy.hard)) != 0
    return hard if not policy.soft else hard | (F.bit_count(failures.bitwiseAND(F.lit(policy.soft))) >= policy.soft_limit)


def apply_policy(led: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with base_failed, kept and policy_version."""
    base = F.col("failures").bitwiseAND(F.lit(0b11)) != 0
    return led.withColumns({"base_failed": base, "kept": ~base & ~rejects(policy, F.col("failures")), "policy_version": F.lit(policy.version)})


def ablation(led: DataFrame, policy: Policy, rules: dict[int, tuple[str, str]] = RULES) -> DataFrame:
    """For each rule: documents that fail it, and documents that only its removal from the policy would keep.

    One pass over the ledger; a row a rule, also on an empty ledger (zeros).
    """
    failures = F.col("failures")
    out = []
    for bit, (name, _) in rules.items():
        without = failures.bitwiseAND(F.lit(~(1 << bit)))
        out += [F.count_if(failures.bitwiseAND(F.lit(1 << bit)) != 0).alias(f"f{bit}"), F.count_if(rejects(policy, failures) & ~rejects(policy, without)).alias(f"o{bit}")]
    one = led.agg(*out)
    return one.select(F.explode(F.array(*[F.struct(F.lit(bit).alias("bit"), F.lit(name).alias("rule"), F.col(f"f{bit}").alias("n_failed"), F.col(f"o{bit}").alias("n_only")) for bit, (name, _) in rules.items()])).alias("r")).select("r.*")


def op9(docs: DataFrame, policy: Policy = POLICIES[2]) -> DataFrame:
    """The contract's columns, with the ledger's mask and the other measurements after them."""
    led = apply_policy(ledger(measure(docs)), policy)
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failures", "n_lines", "n_upper", "n_letters", "policy_version")
