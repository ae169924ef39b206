"""Scalar column expressions: clamps, buckets, safe casts and Brazilian-Portuguese formats."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# Result labels and bounds that callers of the stage tables rely on.
OVERDUE, URGENT, ATTENTION, ON_TRACK, UNKNOWN = (
    "ATRASADO", "URGENTE", "ATENÇÃO", "OK", "DESCONHECIDO",
)
BRING_FORWARD, MAY_POSTPONE, AS_PLANNED = "Antecipar", "Pode adiar", "Conforme"
LAST_REPLACEMENT, PREVIOUS_REPLACEMENT, PREVENTIVE = (
    "ULTIMA_SUBSTITUICAO", "PENULTIMA_SUBSTITUICAO", "PREVENTIVA",
)
FIT_EXCELLENT, FIT_GOOD, FIT_MODERATE = "Excelente", "Bom", "Moderado/baixo"
QUALITY_OK = "Dentro do limite aceitável"
QUALITY_BAD = "Acima da meta — investigar"
MONTH_LABELS = ("Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez")
MISSING_TEXT = "—"


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL although ``greatest`` and ``least`` skip NULLs."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio that is NULL for a zero denominator instead of raising under ANSI."""
    return F.try_divide(numerator, denominator)


def rate_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent, NULL when the whole is zero."""
    return F.round(safe_ratio(part.cast("double"), whole.cast("double")) * 100, digits)


def safe_double(value: Column) -> Column:
    """Parse to double; text that is no number, and NaN, become NULL."""
    parsed = value.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def parse_timestamp(value: Column, formats: Sequence[str]) -> Column:
    """First format that parses wins, so list the day-first pattern ahead of the others."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats])


def day(value: Column) -> Column:
    """Midnight of a timestamp as a date."""
    return F.to_date(value)


def month_start(value: Column) -> Column:
    """Month period, represented by its first day."""
    return F.trunc(value, "month")


def month_key(value: Column) -> Column:
    """Month period as ``yyyy-MM`` text."""
    return F.date_format(value, "yyyy-MM")


def nearly_zero(value: Column, tolerance: float = 1e-8) -> Column:
    return F.abs(value) <= F.lit(tolerance)


def urgency(days_left: Column) -> Column:
    """Urgency of a prescription: overdue < 0 <= urgent < 30 <= attention < 90 <= on track."""
    return (
        F.when(days_left.isNull(), UNKNOWN)
        .when(days_left < 0, OVERDUE)
        .when(days_left < 30, URGENT)
        .when(days_left < 90, ATTENTION)
        .otherwise(ON_TRACK)
    )


def forecast_band(days_left: Column) -> Column:
    """Band of a model forecast; unlike :func:`urgency` its upper bounds are inclusive."""
    return (
        F.when(days_left < 0, OVERDUE)
        .when(days_left <= 30, URGENT)
        .when(days_left <= 90, ATTENTION)
        .when(days_left.isNotNull(), ON_TRACK)
    )


def recommendation(difference: Column, tolerance: int = 30) -> Column:
    """Advice from (model days - historical days)."""
    return (
        F.when(difference < -tolerance, BRING_FORWARD)
        .when(difference > tolerance, MAY_POSTPONE)
        .when(difference.isNotNull(), AS_PLANNED)
    )


def fit_band(r2: Column) -> Column:
    return F.when(r2 >= 0.9, FIT_EXCELLENT).when(r2 >= 0.7, FIT_GOOD).otherwise(FIT_MODERATE)


def quality_label(scrap_rate_pct: Column, limit: float = 1.5) -> Column:
    return F.when(scrap_rate_pct < limit, QUALITY_OK).otherwise(QUALITY_BAD)


def event_label(event_type: Column, notes: Column) -> Column:
    """Readable label of a maintenance event; unmapped types pass through."""
    return (
        F.when(event_type == LAST_REPLACEMENT, "Última troca")
        .when(event_type == PREVIOUS_REPLACEMENT, "Penúltima troca")
        .when(
            event_type == PREVENTIVE,
            F.concat(F.lit("Preventiva (#"), F.coalesce(F.nullif(notes, F.lit("")), F.lit("?")), F.lit(")")),
        )
        .otherwise(event_type)
    )


def format_int(value: Column) -> Column:
    """Integer part with dots as thousands separators: ``1.234.567``."""
    grouped = F.format_number(value.cast("bigint"), 0)
    return F.coalesce(F.translate(grouped, ",", "."), F.lit(MISSING_TEXT))


def format_pct(value: Column) -> Column:
    """Two decimals, comma as decimal mark: ``1.234,56 %``."""
    grouped = F.format_number(value, 2)
    return F.coalesce(F.concat(F.translate(grouped, ",.", ".,"), F.lit(" %")), F.lit(MISSING_TEXT))


def format_day(value: Column) -> Column:
    return F.coalesce(F.date_format(value, "dd/MM/yyyy"), F.lit(MISSING_TEXT))


def format_month(value: Column) -> Column:
    """Portuguese month label such as ``Fev/2024``."""
    names = F.array(*[F.lit(m) for m in MONTH_LABELS])
    label = F.concat(F.element_at(names, F.month(value)), F.lit("/"), F.year(value).cast("string"))
    return F.coalesce(label, F.lit(MISSING_TEXT))


def clean_name(name: str) -> str:
    """Column name without blanks, dots, parentheses, slashes or dashes."""
    # Characters removed from, or replaced by an underscore in, column names.
    return name.translate(str.maketrans({" ": "_", "/": "_", "-": "_", ".": None, "(": None, ")": None}))


def report_version(file_name: Column) -> Column:
    """Number after the last ``_R`` of a report file name; NULL when there is none."""
    return F.nullif(F.regexp_extract(file_name, r"_R(\d+)[^_]*$", 1), F.lit("")).try_cast("int")


def any_prefix(name: Column, prefixes: Iterable[str]) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | name.startswith(prefix)
    return test
