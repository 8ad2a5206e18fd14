"""Column expressions. All of them stay in generated JVM code; there is no Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import presets as P

MONEY = "decimal(12,2)"
CASTS = {
    "date": "date",
    "timestamp": "timestamp_ntz",
    "int": "int",
    "decimal": "decimal(10,2)",
    "cents": "decimal(10,2)",
    "uuid": "string",
}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- money and ratios


def money(col: Column | str, kind: str = MONEY) -> Column:
    """Exact money; more digits round half up."""
    return _c(col).cast(kind)


def total(df: DataFrame, col: str, kind: str = "decimal(22,2)") -> Column:
    """Exact sum of a money column.

    A sum of decimals wider than eight digits is kept as a big-number object per group.
    Up to 16 digits with two decimals fit in whole cents, which Spark adds as a long; an
    overflow (beyond 9e16) is an error in ANSI mode, never a wrong sum.
    """
    type_ = df.schema[col].dataType
    if isinstance(type_, T.DecimalType) and type_.scale == 2 and type_.precision <= 16:
        cents = (F.col(col) * F.lit(100)).cast("long")
        return (F.sum(cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(kind)
    return F.sum(col).cast(kind)


def mean(total: Column, n: Column) -> Column:
    """Unrounded average from an exact sum, NULL for no rows."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def ratio(top: Column, bottom: Column) -> Column:
    """Unrounded ratio, NULL when the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def round_ratio(top: Column, bottom: Column, factor: int = 1) -> Column:
    """Ratio of exact numbers times `factor`, rounded to cents; NULL when the divisor is zero.

    Decimal division keeps 16 digits or more here, so that rounding is not off by the
    last bit of a double.
    """
    wide = "decimal(20,2)"
    return F.round(F.try_divide((top.cast(wide) * F.lit(factor)).cast("decimal(22,2)"), bottom.cast(wide)), 2).cast("decimal(22,2)")


def win_rate(won: Column, bet: Column) -> Column:
    """Won per bet as a float, 0 without bets."""
    return F.when(bet > 0, won.cast("double") / bet.cast("double")).otherwise(F.lit(0.0))


# -- dates


def day_of_week(col: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(col)) - 1


def is_weekend(col: Column | str) -> Column:
    return F.dayofweek(_c(col)).isin(1, 7)


def day_name(col: Column | str, pad: bool = False) -> Column:
    name = F.date_format(_c(col), "EEEE")
    return F.rpad(name, 9, " ") if pad else name


def month_name(col: Column | str, pad: bool = False) -> Column:
    name = F.date_format(_c(col), "MMMM")
    return F.rpad(name, 9, " ") if pad else name


def years_between(later: Column | str, earlier: Column | str) -> Column:
    """Full years: the birthday of someone born on 29 February is 1 March in other years."""
    a, b = _c(later), _c(earlier)
    before = F.month(a) * 100 + F.dayofmonth(a) < F.month(b) * 100 + F.dayofmonth(b)
    return F.year(a) - F.year(b) - before.cast("int")


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole minutes, half a minute rounds up."""
    micros = F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))
    return F.floor((micros + F.lit(30_000_000)) / F.lit(60_000_000)).cast("int")


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    micros = F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))
    return micros.cast("double") / F.lit(3_600_000_000.0)


# -- classes


def tier(points: Column | str, tiers: Sequence[tuple[str, int]] = P.TIERS_WAREHOUSE, default: str = P.TIER_DEFAULT) -> Column:
    chain = F.when(F.lit(False), F.lit(default))
    for name, lowest in tiers:
        chain = chain.when(_c(points) >= lowest, F.lit(name))
    return chain.otherwise(F.lit(default))


def band(age: Column, bands: Sequence[tuple[str, int]] = P.BANDS_WAREHOUSE, default: str = P.BANDS_WAREHOUSE_DEFAULT) -> Column:
    chain = F.when(F.lit(False), F.lit(default))
    for name, below in bands:
        chain = chain.when(age < below, F.lit(name))
    return chain.otherwise(F.lit(default))


def age_band(born: Column | str, as_of: Column, bands: Sequence[tuple[str, int]] = P.BANDS_WAREHOUSE, default: str = P.BANDS_WAREHOUSE_DEFAULT) -> Column:
    return band(years_between(as_of, born), bands, default)


def map_like(col: Column | str, rules: Sequence[tuple[str, str]], default: str, any_case: bool = False) -> Column:
    """First matching LIKE pattern decides; NULL text takes the default."""
    text = _c(col)
    chain = F.when(F.lit(False), F.lit(default))
    for pattern, value in rules:
        chain = chain.when(text.ilike(pattern) if any_case else text.like(pattern), F.lit(value))
    return chain.otherwise(F.lit(default))


def department(position: Column | str) -> Column:
    return map_like(position, P.DEPARTMENTS, P.DEPARTMENT_DEFAULT)


def device_class(device: Column | str) -> Column:
    return map_like(device, P.DEVICE_CLASSES, P.DEVICE_DEFAULT, any_case=True)


def normalise(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """Stored word for an accepted spelling, any case and outer blanks; NULL for other text."""
    spelled = F.lower(F.trim(_c(col)))
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for spelling, word in mapping.items():
        chain = chain.when(spelled == spelling, F.lit(word))
    return chain


# -- text


def matches(col: Column | str, kind: str) -> Column:
    """Three-valued: NULL stays NULL."""
    return _c(col).rlike(P.PATTERNS[kind])


def safe_cast(col: Column | str, kind: str) -> Column:
    """Value when the text has the format and is a value of the type, else NULL."""
    text = _c(col)
    return F.when(text.rlike(P.PATTERNS[kind]), text.try_cast(CASTS[kind]))


def initcap(col: Column | str) -> Column:
    """Upper case after every character that is no letter or digit, lower case elsewhere.

    Spark's own function starts a word at blanks only ("Slot-machine").
    """
    words = F.split(F.lower(_c(col)), r"(?<=[^\p{L}\p{N}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))), "")


def truncate(col: Column | str, n: int) -> Column:
    return F.left(_c(col), F.lit(n))


def fill(col: Column | str, default) -> Column:
    return F.coalesce(_c(col), F.lit(default))


# -- keys


def surrogate(*cols: Column | str) -> Column:
    """Key that every run computes alike from the natural key."""
    return F.xxhash64(*[_c(c) for c in cols])


def row_uuid(*cols: Column | str) -> Column:
    """A key in the form of a UUID, from the row's own values: a retried task gives the same one."""
    digest = F.md5(F.to_json(F.struct(*[_c(c).alias(f"c{i}") for i, c in enumerate(cols)])).cast("binary"))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")


def points_earned(kind: Column | str, amount: Column | str) -> Column:
    return F.when(_c(kind) == "Bet", F.floor(_c(amount))).otherwise(F.lit(0)).cast("int")


def points_redeemed(kind: Column | str, amount: Column | str) -> Column:
    return F.when(_c(kind) == "Withdraw", F.floor(_c(amount))).otherwise(F.lit(0)).cast("int")
