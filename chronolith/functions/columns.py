"""Scalar functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Texts that stand for a missing category.
MISSING = ("", "none", "nan", "null", "<na>", "nat")
#: Fixed value: the two-sided 90 % quantile of the normal distribution.
Z90 = 1.6448536269514722


def finite(c: Column) -> Column:
    """The value, or null if it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def ratio(a: Column, b: Column) -> Column:
    """a / b; null for a zero denominator."""
    return F.try_divide(a, b)


def parse_duration(c: Column) -> Column:
    """Seconds of ``M:SS.mmm`` or ``SS.mmm``; blank and unreadable texts are null."""
    text = F.trim(c)
    minutes = F.when(text.contains(":"), F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double")).otherwise(F.lit(0.0))
    seconds = F.when(text.contains(":"), F.split_part(text, F.lit(":"), F.lit(2))).otherwise(text).try_cast("double")
    return F.when(text != "", minutes * 60 + seconds)


def format_duration(c: Column) -> Column:
    """``m:ss.mmm`` of seconds."""
    ms = F.round(c * 1000).cast("long")
    return F.when(c.isNotNull(), F.concat(F.floor(ms / 60000).cast("string"), F.lit(":"), F.lpad(F.floor(ms % 60000 / 1000).cast("string"), 2, "0"), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0")))


def category(c: Column) -> Column:
    """Upper case without blanks at the ends; missing markers are UNKNOWN."""
    return F.when(c.isNull() | F.lower(F.trim(c)).isin(*MISSING), F.lit("UNKNOWN")).otherwise(F.upper(F.trim(c)))


def surrogate_key(*columns: str) -> Column:
    """md5 over the columns; nulls have a placeholder of their own."""
    return F.md5(F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("_null_")) for c in columns]))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Text of the first rule that holds; null if none does."""
    if not rules:
        return F.lit(None).cast("string")
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, text in rules[1:]:
        out = out.when(condition, F.lit(text))
    return out


def tier(c: Column, *steps: tuple[float, str], other: str) -> Column:
    """Label of the first threshold that the value reaches."""
    return F.coalesce(first_reason(*[(c >= least, label) for least, label in steps]), F.lit(other))


def structured_gap(c: Column) -> tuple[Column, Column]:
    """(seconds, laps) of a gap given as seconds or ``+N LAP(S)``."""
    laps = F.regexp_extract(F.upper(F.trim(c)), r"^\+?(\d+) LAPS?$", 1)
    return F.trim(c).try_cast("double"), F.when(laps != "", laps.cast("int"))


def log_gap(a: Column, b: Column) -> Column:
    """100 * (ln a - ln b)."""
    return 100 * (F.ln(a) - F.ln(b))


def wilson(hits: Column, n: Column, least: int = 5) -> tuple[Column, Column]:
    """90 % Wilson interval of hits / n in percent; null for fewer than ``least`` trials."""
    share = ratio(hits, n)
    middle = share + F.try_divide(F.lit(Z90 * Z90), 2 * n)
    width = Z90 * F.sqrt(F.try_divide(share * (1 - share), n) + F.try_divide(F.lit(Z90 * Z90), 4 * n * n))
    bottom = 1 + F.try_divide(F.lit(Z90 * Z90), n)
    return tuple(F.when(n >= least, 100 * F.try_divide(x, bottom)) for x in (middle - width, middle + width))  # type: ignore[return-value]


def composite_id(year: Column, round_: Column, letter: str, number: Column) -> Column:
    """``2024-R01-B0001``."""
    return F.format_string(f"%d-R%02d-{letter}%04d", year, round_, number)


def compass(degrees: Column) -> Column:
    """One of eight winds."""
    names = F.array(*[F.lit(x) for x in ("N", "NE", "E", "SE", "S", "SW", "W", "NW")])
    return F.element_at(names, (F.pmod(F.floor((degrees + 22.5) / 45), F.lit(8)) + 1).cast("int"))


def phase(value: Column, last: Column, opening: float = 0.25, middle: float = 0.70) -> Column:
    """Opening, Middle or Closing by the share of the last value."""
    return F.when(value <= opening * last, "Opening").when(value <= middle * last, "Middle").otherwise("Closing")


def dominant(*parts: tuple[str, Column]) -> Column:
    """Struct (size, name, value) of the part with the largest absolute value; the first name wins a tie."""
    best = F.array_max(F.array(*[F.struct(F.abs(c).alias("size"), F.lit(-i).alias("turn"), F.lit(n).alias("name"), c.alias("value")) for i, (n, c) in enumerate(parts)]))
    return F.struct(best["size"].alias("size"), best["name"].alias("name"), best["value"].alias("value"))


def marker(message: Column) -> Column:
    """Struct (kind, edge) of a race-control message; null fields for other messages."""
    text = F.regexp_replace(F.upper(F.trim(message)), r"\s+", " ")
    kind = F.when(text.contains("VIRTUAL SAFETY CAR") | text.rlike(r"\bVSC\b"), "VSC").when(text.contains("SAFETY CAR"), "SC").when(text.contains("RED FLAG"), "RED")
    edge = F.when(text.rlike("DEPLOYED|RED FLAG"), "start").when(text.rlike("ENDING|IN THIS LAP|WITHDRAWN"), "end")
    return F.struct(kind.alias("kind"), edge.alias("edge"))


def preferred(c: Column, unknown: str = "UNKNOWN") -> Column:
    """Aggregate: the largest known value, else the unknown one."""
    return F.coalesce(F.max(F.when(c != unknown, c)), F.lit(unknown))


def freshness(age: Column, fresh: int, ageing: int) -> Column:
    """fresh, ageing or stale by an age in days."""
    return F.when(age <= fresh, "fresh").when(age <= ageing, "ageing").otherwise("stale")


def rms(*parts: Column) -> Column:
    """Root of the mean square."""
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return F.sqrt(total / len(parts))


def score(*parts: tuple[float, Column]) -> Column:
    """Weighted sum, clipped to 0..1."""
    total = F.lit(0.0)
    for weight, c in parts:
        total = total + weight * c
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))


def slope(y: Column, x: Column) -> Column:
    """Aggregate: regression slope; null if x does not vary, which sums of floating-point parts alone do not tell."""
    return F.when(F.max(x) > F.min(x), F.regr_slope(y, x))
