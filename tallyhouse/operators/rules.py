"""Declared row rules: count, split, drop or stop on rows that break them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S


class GateError(ValueError):
    """A batch was refused; `counts` has the number of broken rows per rule."""

    def __init__(self, message: str, counts: Mapping[str, int]):
        super().__init__(f"{message}: " + ", ".join(f"{k}={v}" for k, v in counts.items() if v))
        self.counts = dict(counts)


@dataclass(frozen=True)
class Rule:
    """`ok` may be NULL (three-valued logic); `null` says whether that passes."""

    name: str
    ok: Column
    null: str = "fail"

    def broken(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(self.null == "pass"))


def required(*cols: str, blank: str = "trimmed") -> list[Rule]:
    """Not NULL and, unless blank="allowed", not empty ("empty": '' only; "trimmed": blanks too)."""
    rules = []
    for name in cols:
        ok = F.col(name).isNotNull()
        if blank == "empty":
            ok = ok & (F.col(name) != "")
        elif blank == "trimmed":
            ok = ok & (F.trim(F.col(name)) != "")
        rules.append(Rule(f"{name} required", ok, "fail"))
    return rules


def matches(col: str, kind: str, null: str = "fail") -> Rule:
    return Rule(f"{col} not {kind}", S.matches(col, kind), null)


def castable(col: str, kind: str, null: str = "fail") -> Rule:
    """Format and value: month 13 has the format of a date but is none."""
    value = S.safe_cast(col, kind)
    return Rule(f"{col} not {kind}", F.when(F.col(col).isNotNull(), value.isNotNull()), null)


def in_domain(col: str, values: Sequence[str], null: str = "pass") -> Rule:
    return Rule(f"{col} not in domain", F.col(col).isin(*values), null)


def max_length(col: str, n: int, null: str = "pass") -> Rule:
    return Rule(f"{col} longer than {n}", F.length(F.col(col)) <= n, null)


def at_least(col: str, low, null: str = "pass") -> Rule:
    return Rule(f"{col} below {low}", F.col(col) >= F.lit(low), null)


# -- applying rules


def count_broken(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, `rule` and `broken`, from a single pass over `df`."""
    one = df.agg(*[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("broken")) for i, r in enumerate(rules)])
    return one.select(F.inline(pairs))


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, in rule order."""
    return F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good, bad); bad rows carry `reasons`. Both are lazy filters over the same scan."""
    bad = any_broken(rules)
    return df.where(~bad), df.where(bad).withColumn("reasons", reasons(rules))


def any_broken(rules: Sequence[Rule]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | rule.broken()
    return out


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.where(~any_broken(rules))


def gate(df: DataFrame, rules: Sequence[Rule], message: str = "validation failed") -> DataFrame:
    """Stop the batch when any row breaks a rule: one aggregate job, one row to the driver."""
    counts = {row["rule"]: row["broken"] for row in count_broken(df, rules).collect()}
    if any(counts.values()):
        raise GateError(message, counts)
    return df


# -- cleansing


def drop_empty(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("all", subset=list(cols) if cols else None)


def trim_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: S.fill(c, v) for c, v in defaults.items()})


def truncate_cols(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: S.truncate(c, n) for c, n in limits.items()})


def normalise(df: DataFrame, col: str, mapping: Mapping[str, str], unknown: str = "drop") -> DataFrame:
    """Map spellings to stored words; unknown="keep" leaves them NULL."""
    out = df.withColumn(col, S.normalise(col, mapping))
    return out.where(F.col(col).isNotNull()) if unknown == "drop" else out


def cast_all(df: DataFrame, kinds: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Cast text columns after a gate; safe=True gives NULL for what the gate did not see."""
    if safe:
        return df.withColumns({c: S.safe_cast(c, k) for c, k in kinds.items()})
    return df.withColumns({c: F.col(c).cast(S.CASTS[k]) for c, k in kinds.items()})


def profile(df: DataFrame, col: str) -> DataFrame:
    """Raw values of a category and their number of rows."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
