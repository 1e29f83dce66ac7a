"""Scalar column functions on numbers, codes and dates. All are native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_map(mapping: Mapping) -> Column:
    """Dictionary as a map literal (dictionaries here are short and given by the caller)."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def recode(c: Column, mapping: Mapping) -> Column:
    """Replace listed values, keep all others."""
    return F.coalesce(F.try_element_at(literal_map(mapping), c), c)


def map_strict(c: Column, mapping: Mapping, on_unknown: str = "null") -> Column:
    """Replace listed values; others become NULL, or raise with ``on_unknown='error'``."""
    found = F.try_element_at(literal_map(mapping), c)
    if on_unknown == "null":
        return found
    message = F.concat(F.lit("no code for value: "), c.cast("string"))
    return F.when(found.isNull() & c.isNotNull(), F.raise_error(message)).otherwise(found)


def round_scaled(c: Column, digits: int) -> Column:
    """Rounded as SQL engines on doubles do: the scaled double to the nearest whole number, halves away from zero.

    ``F.round`` judges the shortest decimal text instead, which calls other doubles a half, and drops the sign of a zero.
    """
    return F.signum(c) * F.round(F.abs(c) * 10.0**digits) / 10.0**digits


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def safe_float(c: Column, default: float = 0.0) -> Column:
    """Number in the text, or ``default``."""
    return F.coalesce(c.try_cast("double"), F.lit(default))


def parse_bool(c: Column, default: bool = True) -> Column:
    """Text token to boolean; NULL and blank give ``default``."""
    # fixed values: accepted spellings of true
    true_words = ["1", "true", "yes", "y", "on", "ano"]
    token = F.lower(F.trim(c.cast("string")))
    return F.when(token.isNull() | (token == ""), F.lit(default)).otherwise(token.isin(true_words))


def ratio_guarded(part: Column, total: Column, digits: int = 2) -> Column:
    """part / total in percent, NULL when total is not positive."""
    return F.when(total > 0, F.round(part / total * 100, digits))


def target_binary(c: Column, positive: str = "yes", negative: str = "no", unknown: str = "zero") -> Column:
    """Yes/no text to 1/0. ``unknown``: 'zero', 'null' or 'error' for any other text."""
    token = F.lower(F.trim(c))
    flag = F.when(token == positive, F.lit(1)).when(token == negative, F.lit(0))
    if unknown == "null":
        return flag
    if unknown == "error":
        return flag.otherwise(F.raise_error(F.concat(F.lit("not a yes/no value: "), F.coalesce(c, F.lit("NULL")))))
    return flag.otherwise(F.lit(0))


def banded(c: Column, upper_bounds: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first band whose upper bound is not exceeded; NULL stays NULL."""
    label = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, name in upper_bounds:
        label = label.when(c <= bound, F.lit(name))
    return label.otherwise(F.lit(top))


def risk_bucket(p: Column) -> Column:
    """Risk band of a probability; outside (-0.1, 1.1] there is none."""
    # fixed values: band limits
    band = banded(p, [(0.25, "Low"), (0.34, "Medium")], "High")
    return F.when((p > -0.1) & (p <= 1.1), band)


def verdict_bucket(score: Column) -> Column:
    # fixed values: verdict texts and their lower limits
    return (
        F.when(score >= 80, F.lit("Vhodny kandidat"))
        .when(score >= 60, F.lit("Skor vhodny kandidat"))
        .when(score >= 40, F.lit("Ciastocne vhodny / vyzaduje manualne posudenie"))
        .otherwise(F.lit("Slaba zhoda s poziciou"))
    )


def status_icon(status: Column) -> Column:
    # fixed values: icon per status
    icons = {"splnene": "✅", "ciastocne_splnene": "🟡", "nesplnene": "❌", "nejasne": "⚪"}
    return F.coalesce(F.try_element_at(literal_map(icons), status), F.lit("⚪"))


def percent_format(p: Column) -> Column:
    return F.concat(F.round(p * 100, 2).cast("string"), F.lit("%"))


def percent_parse(text: Column) -> Column:
    """'12,5%' to 12.5; NULL when it is no number."""
    return F.translate(text, ",%", ".").try_cast("double")


def week_start(ts: Column) -> Column:
    """Monday of the week; a Sunday counts to the week that starts on the next day."""
    return F.to_date(F.date_trunc("week", F.date_add(F.to_date(ts), 1)))


def within_last(ts: Column, reference: Column, days: int) -> Column:
    return ts >= reference - F.make_dt_interval(F.lit(days))


def history_window(ts: Column, reference: Column, years: int = 4) -> Column:
    return F.to_date(ts) >= F.add_months(reference, -12 * years)


def refund_eligible(ordered: Column, reference: Column, days: int = 30) -> Column:
    """Whole days since the order do not exceed ``days``; a missing order date is false."""
    seconds = F.timestamp_diff("SECOND", ordered, reference)
    return F.coalesce(F.floor(seconds / 86400) <= days, F.lit(False))


def iso_event_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def period_parse(label: Column) -> Column:
    """First day of '2007', '2007-03' or '2007-Q2'."""
    year = F.substring(label, 1, 4).try_cast("int")
    quarter = F.regexp_extract(label, r"^\d{4}-Q([1-4])$", 1).try_cast("int")
    month = F.regexp_extract(label, r"^\d{4}-(\d{2})$", 1).try_cast("int")
    return (
        F.when(label.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1)))
        .when(quarter.isNotNull(), F.make_date(year, quarter * 3 - 2, F.lit(1)))
        .when(month.between(1, 12), F.make_date(year, month, F.lit(1)))
    )


def tool_fold(operation: Column, operands: Column) -> Column:
    """Left-to-right arithmetic over an operand array; an unknown operation raises."""

    def step(acc: Column, x: Column) -> Column:
        return (
            F.when(operation == "add", acc + x)
            .when(operation == "subtract", acc - x)
            .when(operation == "multiply", acc * x)
            .when(operation == "divide", F.try_divide(acc, x))
            .otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), operation)).cast("double"))
        )

    return F.aggregate(F.slice(operands, 2, F.greatest(F.size(operands) - 1, F.lit(0))), F.get(operands, F.lit(0)), step)


def hash_unit(*cols: Column, seed: int = 0) -> Column:
    """Uniform number in [0, 1) that depends on the values and the seed only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16**12)


def argmax(values: Column) -> Column:
    """Zero-based index of the largest entry."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
