"""One load of one text file: rules, casts, referential drops, one row per key, upsert, report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators import dedup, merge, quality, referential, rules
from tallyhouse.schemas import TABLES, TableSpec
from tallyhouse.session import settle
from tallyhouse.sources.csv import SCAN_ORDER, read_csv_staging


@dataclass
class Load:
    """`rows` is the new table; `merged` the same with `action`; `rejected` has `reasons`."""

    rows: DataFrame
    merged: DataFrame
    rejected: DataFrame
    orphans: dict[str, DataFrame]
    report: DataFrame


def stage(spark: SparkSession, spec: TableSpec, path: str, multiline: bool | None = None) -> DataFrame:
    """The text file, with the place of each row where the last row per key wins."""
    return read_csv_staging(spark, path, list(spec.columns), spec.force_null, multiline, ordered=spec.dedup == "last")


def row_rules(spec: TableSpec) -> list[rules.Rule]:
    out = rules.required(*spec.required, blank=spec.blank)
    out += [rules.castable(c, spec.columns[c], null) for c, null in spec.formats.items()]
    out += [rules.in_domain(c, allowed, null) for c, (allowed, null) in spec.domains.items()]
    out += [rules.Rule(f"{c} empty", F.col(c) != "", "pass") for c in spec.not_empty]
    return out


def rejects(spec: TableSpec, staged: DataFrame) -> DataFrame:
    """The rows that break a row rule, with their `reasons`; nothing is loaded or written."""
    rows = rules.drop_empty(staged, list(spec.columns)) if spec.force_null else staged
    checks = row_rules(spec)
    return rows.where(rules.any_broken(checks)).withColumn("reasons", rules.reasons(checks))


def load(spec: TableSpec, staged: DataFrame, current: DataFrame | None, parents: Mapping[str, DataFrame], null_fk: str = "drop") -> Load:
    """Gates run one aggregate each; the rows that get in are written once, since the upsert reads them several times."""
    names = list(spec.columns)
    # Elsewhere a row without any value breaks a rule like any other.
    rows = rules.drop_empty(staged, names) if spec.force_null else staged
    checks = row_rules(spec)
    bad = rules.any_broken(checks)
    if spec.stop_on_null:
        rules.gate(rows, rules.required(*spec.stop_on_null, blank="allowed"), f"{spec.name}: value missing")
    if spec.bad_rows == "stop":
        rules.gate(rows, checks, f"{spec.name}: validation failed")
    good = rows.where(~bad)
    rejected = rejects(spec, staged)

    if spec.trim:
        good = rules.trim_cols(good, spec.trim)
    for col, mapping in spec.normalise.items():
        good = good.withColumn(col, S.normalise(col, mapping))
    kinds = {c: k for c, k in spec.columns.items() if k != "text"}
    good = rules.cast_all(good, kinds, safe=True)
    if spec.defaults:
        good = rules.fill_defaults(good, spec.defaults)
    if spec.limits:
        good = rules.truncate_cols(good, spec.limits)

    # Unknown keys are reported from all valid rows, not only from those the other keys left in.
    lost, valid = {}, good
    for col, (parent, parent_col) in spec.foreign.items():
        if col in spec.missing:
            # Only rows that are still in: an unknown game takes its row out before the place is asked for.
            referential.fk_gate(good, parents[parent], col, parent_col, f"{spec.name}: unknown {col}")
        else:
            lost[col] = referential.orphans(valid, parents[parent], col, parent_col)
            good = referential.fk_keep(good, parents[parent], col, parent_col, "keep" if null_fk == "keep" and col not in spec.required else "drop")

    key = [F.lower(F.trim(F.col(k))) for k in spec.key] if spec.key_folded else list(spec.key)
    if spec.dedup == "latest":
        # A missing number sorts first from the top, a missing time last.
        nulls_first = spec.key_folded
        order = [F.col(c).desc_nulls_first() if nulls_first else F.col(c).desc_nulls_last() for c in spec.latest_by]
        good = dedup.keep_latest(good, key, order)
    elif spec.dedup == "one":
        good = dedup.keep_one(good, key)
    elif spec.dedup == "last":
        good = dedup.keep_last(good, key, SCAN_ORDER)
    for col in spec.normalise:
        good = good.where(F.col(col).isNotNull())
    good = settle(good.select(*names), f"load-{spec.name}")
    if spec.dedup == "refuse":
        repeats = dedup.duplicate_keys(good, spec.key).agg(F.count(F.lit(1))).first()[0]
        if repeats:
            raise rules.GateError(f"{spec.name}: key repeated in one batch", {", ".join(spec.key): repeats})

    if current is None:
        # A filter that is false by itself: Spark then plans the load without the merge.
        current = good.where(F.lit(False))
    merged = merge.upsert(current, good, list(spec.key))
    report = quality.load_report(rows, merged, bad)
    return Load(merged.drop("action"), merged, rejected, lost, report)


def load_file(spark: SparkSession, name: str, path: str, current: DataFrame | None = None, parents: Mapping[str, DataFrame] | None = None, null_fk: str = "drop", multiline: bool | None = None) -> Load:
    """Load the file of a known table; the text is parsed once into a staging table. `multiline` says if quoted fields hold line
    breaks; else that is looked up."""
    spec = TABLES[name]
    return load(spec, settle(stage(spark, spec, path, multiline), f"stage-{name}"), current, parents or {}, null_fk)


# Parents before children.
LOAD_ORDER = (
    "player",
    "staff",
    "casino_location",
    "game",
    "player_game",
    "table_game",
    "staff_assigned_tables",
    "slot_machine",
    "slot_play",
    "reward",
    "player_reward",
    "transaction",
    "game_result",
    "login_history",
    "audit_log",
)
