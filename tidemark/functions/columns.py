"""Column helpers shared by the staging models and the marts. All stay inside Catalyst."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = T.DecimalType(18, 2)

# Text layouts tried in turn for timestamps that arrive as strings.
TIMESTAMP_LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy/MM/dd[ HH:mm:ss]",
    "dd/MM/yyyy[ HH:mm:ss]",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
)


def cent() -> Column:
    return F.lit(Decimal("0.01"))


def lower_clean(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c).cast("string")))


def upper_clean(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c).cast("string")))


def has_text(c: Column | str) -> Column:
    """True for a key that is neither NULL nor blank."""
    c = _col(c)
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def pad_sql(prefix: str, n: str, width: int) -> str:
    """SQL text of `prefix` + zero-padded number. Numbers wider than `width` keep all their digits."""
    digits = f"cast({n} as string)"
    return f"concat('{prefix}', CASE WHEN length({digits}) >= {width} THEN {digits} ELSE lpad({digits}, {width}, '0') END)"


def pad_key(prefix: str, n: str, width: int) -> Column:
    return F.expr(pad_sql(prefix, n, width))


def pick_sql(values: list[str] | tuple[str, ...], index: str) -> str:
    """SQL text of `values[index]`, with `index` counted from 0."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({items}), cast(({index}) + 1 as int))"


def pick(values: list[str] | tuple[str, ...], index: str) -> Column:
    return F.expr(pick_sql(values, index))


def mask_phone(c: Column | str) -> Column:
    text = _col(c).cast("string")
    last_two = F.substring(text, F.greatest(F.length(text) - 1, F.lit(1)), F.lit(2))
    return F.concat(F.substring(text, F.lit(1), F.lit(6)), F.lit("****"), last_two)


def email_digest(c: Column | str) -> Column:
    return F.sha2(lower_clean(c), 256)


def money(c: Column | str) -> Column:
    """Decimal(18,2), dropping further digits toward zero instead of rounding.

    The digits are cut as text, before any type could round them. NULL for text that is no number
    and for amounts that do not fit.
    """
    text = F.trim(_col(c).cast("string"))
    cut = F.regexp_replace(text, r"^([+-]?[0-9]*[.][0-9]{2})[0-9]+$", "$1")
    exact = cut.try_cast(T.DecimalType(38, 18))  # an exponent keeps its digits up to here
    units = F.floor(F.abs(exact) * 100).try_cast(T.DecimalType(18, 0)) * cent()
    return F.when(exact < 0, -units).otherwise(units).try_cast(MONEY)


def money_of(df: DataFrame, name: str) -> Column:
    """`money` for a column of `df`; a plain cast where nothing can be lost."""
    kind = df.schema[name].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if whole or (isinstance(kind, T.DecimalType) and kind.scale <= 2):
        return F.col(name).cast(MONEY)
    return money(name)


def cents(c: Column | str) -> Column:
    """Whole cents of an amount as bigint; later arithmetic stays in long integers."""
    return (_col(c) * 100).cast("bigint")


def ratio4(numerator_cents: Column, denominator_cents: Column) -> Column:
    """Ratio of two amounts in cents as double, rounded half away from zero to 4 digits.

    Integer arithmetic keeps it exact. NULL unless the denominator is positive.
    """
    den = F.when(denominator_cents > 0, denominator_cents)
    scaled = numerator_cents * 20000
    half_up = F.call_function("div", scaled + F.when(scaled < 0, -den).otherwise(den), den * 2)
    return half_up.cast("double") / F.lit(10000.0)


def timestamp_of(df: DataFrame, name: str) -> Column:
    """Timestamp with second resolution; text is parsed by layout, bad text gives NULL."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        text = F.trim(c)
        epoch = F.when(text.rlike("^[0-9]{10}$"), F.timestamp_seconds(F.expr(f"try_cast(trim(`{name}`) as bigint)")))
        parsed = [F.try_to_timestamp(text, F.lit(layout)) for layout in TIMESTAMP_LAYOUTS]
        c = F.coalesce(epoch, F.try_to_timestamp(text), *parsed)
    return F.date_trunc("second", c.cast("timestamp"))


def iso_weekday(c: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_col(c)) + 1


def date_key(c: Column | str) -> Column:
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def surrogate(*parts: Column | str) -> Column:
    """md5 over the parts joined by `|`; NULL if a part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        pieces += ([F.lit("|")] if i else []) + [_col(part).cast("string")]
    return F.md5(F.concat(*pieces))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
