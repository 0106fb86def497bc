"""Quality rules as a bitmask ledger (DataFrame functions only).

``measure`` evaluates every rule of the catalogue once per document: the measurements
and one bit per failed rule.  ``store`` writes them, one folder per catalogue version
(``CATALOGUE``, a function of the rules), so a changed catalogue never mixes with an older
one.  ``apply_policy`` then decides from the stored bits alone (a policy is a version and
the set of rules it enforces), and ``ablation`` compares policies, or a policy without each
of its rules, in one pre-aggregated pass of bitwise counts - no text is read again.

All measurements are per-row expressions, so the ledger is one scan without a
shuffle.  Repeated three-word windows are found inside the row: windows are
compared as strings, and only a document that has a repeated window sorts them.
NULL text counts as empty (0 words, so it fails ``few_words``); rows are
independent, so repeated rows repeat their result; an empty table gives an
empty ledger (and all-zero ablation counts).  A very long text is measured whole, its
windows in memory one row at a time.  Only ``doc_id`` and ``text`` are
read, other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import text_or_empty, without_spaces, words
from tierlake.session import scratch_path

SYMBOLS = "#*$%&|<>"

# Rule catalogue: bit = position.  A rule is a boolean over the measurements that
# is true when the document FAILS it; all comparisons are in integers.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "upper_case": "100 * n_upper > 40 * word_chars",
}
BASE_RULES = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", BASE_RULES)
STRICT = Policy("v1", tuple(RULES))


def _threes(w: Column, n: Column) -> Column:
    """The three-word windows in order, each as one string."""
    return F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
                       lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))


def _covered(ordered: Column) -> Column:
    """Words covered by windows that have an equal neighbour in sorted order."""
    twin = F.filter(ordered, lambda x, k: (x["w"] == F.get(ordered, k - 1)["w"]) | (x["w"] == F.get(ordered, k + 1)["w"]))
    return F.size(F.array_distinct(F.flatten(F.transform(
        twin, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))


def measure(docs: DataFrame) -> DataFrame:
    """The ledger: doc_id, measurements and ``fail_bits``."""
    m = docs.select("doc_id", text_or_empty().alias("text"))
    m = m.withColumns({
        "__w": words(F.col("text")),
        "__l": F.filter(F.split("text", "\n"), lambda x: F.length(without_spaces(x)) > 0),
        "word_chars": F.length(without_spaces(F.col("text"))).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
        "n_upper": (F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
    })
    m = m.withColumns({
        "n_words": F.size("__w").cast("long"), "n_lines": F.size("__l").cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "__n": F.size("__w"),
    })
    # One column per step: an expression that is used inside a lambda is evaluated
    # for every element unless it is a column of its own.
    m = m.withColumn("__threes", _threes(F.col("__w"), F.col("__n")))
    repeats = (F.col("__n") >= 4) & (F.size(F.array_distinct("__threes")) < F.col("__n") - 2)
    m = m.withColumn("__ordered", F.when(repeats, F.array_sort(F.transform(
        "__threes", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    m = m.withColumn("n_repeat_words", F.when(F.col("__ordered").isNotNull(), _covered(F.col("__ordered")))
                     .otherwise(0).cast("long"))
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
            for bit, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return m.select("doc_id", "n_words", "n_lines", "word_chars", "n_symbols", "n_upper", "n_dup_lines",
                    "n_repeat_words", total.alias("fail_bits"))


# Changes with the rules, their order and their thresholds.
CATALOGUE = f"{zlib.crc32(repr(sorted(RULES.items())).encode() + repr(list(RULES)).encode()):08x}"


def store(docs: DataFrame, path: str | None = None) -> str:
    """Measure ``docs`` and write the ledger of the present catalogue under ``path``; other
    catalogues' ledgers there stay.  Returns the path."""
    path = path or scratch_path(docs.sparkSession, "rule-ledger")
    measure(docs).write.mode("overwrite").parquet(f"{path}/catalogue={CATALOGUE}")
    return path


def read_ledger(spark: SparkSession, path: str, catalogue: str = CATALOGUE) -> DataFrame:
    """The stored ledger of a catalogue version."""
    return spark.read.parquet(f"{path}/catalogue={catalogue}")


def fails(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(ledger: DataFrame, policy: Policy = STRICT, base: Policy = BASE) -> DataFrame:
    """Decide from the stored bits: ``base_failed``, ``policy`` and ``kept``."""
    return ledger.withColumns({"base_failed": fails(base), "policy": F.lit(policy.version),
                               "kept": ~fails(base) & ~fails(policy)})


def ablation(ledger: DataFrame, policies: Iterable[Policy] = (STRICT,)) -> DataFrame:
    """Per policy and rule: documents failing the rule, failing only that rule,
    and kept when the rule is left out.  One aggregate over the bits."""
    policies = list(policies)
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for p in policies:
        hit = F.col("fail_bits").bitwiseAND(F.lit(p.mask))
        for r in p.rules:
            bit = Policy("", (r,)).mask
            name = f"{p.version}/{r}"
            aggs += [F.count(F.when(hit.bitwiseAND(F.lit(bit)) != 0, 1)).alias(f"{name}/fails"),
                     F.count(F.when(hit == bit, 1)).alias(f"{name}/only"),
                     F.count(F.when(hit.bitwiseAND(F.lit(p.mask & ~bit)) == 0, 1)).alias(f"{name}/kept")]
            rows.append(F.struct(F.lit(p.version).alias("policy"), F.lit(r).alias("rule"),
                                 F.col(f"`{name}/fails`").alias("failing"), F.col(f"`{name}/only`").alias("only_this"),
                                 F.col(f"`{name}/kept`").alias("kept_without")))
    return ledger.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
