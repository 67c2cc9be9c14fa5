"""Tolerant casts and the text form of typed values.

Values are judged by a pattern before ``try_cast``, because ``try_cast`` alone also accepts
texts such as ``NaN`` or ``1998-1`` that are not numbers or dates in a source file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What counts as a number, an integer, a date or a point in time.
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"
ISO_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$"
ZONED_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})$"
YEAR_FIRST_DATE = r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$"
SLASH_DATE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
NAMED_MONTH_DATE = r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$"
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
TRUE_TEXTS = ("true", "1", "yes", "y")
FALSE_TEXTS = ("false", "0", "no", "n")


def _starts_like_number(text: Column) -> Column:
    # Digits, signs and the point all sort up to "9"; most other texts skip the pattern.
    return F.substring(text, 1, 1) <= "9"


def is_number(text: Column) -> Column:
    return _starts_like_number(text) & text.rlike(NUMBER)


def is_integer(text: Column) -> Column:
    return _starts_like_number(text) & text.rlike(INTEGER)


def try_double(text: Column) -> Column:
    return F.when(is_number(text), text.try_cast("double"))


def try_number(text: Column, precision: int = 38, scale: int = 0) -> Column:
    """A decimal, rounded half up to ``scale``; null where the text is not a number or too large."""
    return F.when(is_number(text), text.try_cast(f"decimal({precision},{scale})"))


def try_time(text: Column) -> Column:
    """A timestamp without zone from the forms exports use.

    ISO dates and times, the latter also with a zone, which takes them to UTC; ``M/d/yyyy`` and
    ``yyyy/M/d``; ``d-MMM-yyyy`` with an English month in any case.
    """
    zone = F.coalesce(F.nullif(F.regexp_extract(text, "(Z|[+-][0-9]{2}:?[0-9]{2})$", 1), F.lit("")), F.lit("Z"))
    offset = F.when(zone == "Z", 0).otherwise(
        F.concat(F.substring(zone, 1, 1), F.lit("1")).try_cast("int")
        * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, -2, 2).try_cast("int"))
    )
    local = F.regexp_replace(text, "(Z|[+-][0-9]{2}:?[0-9]{2})$", "").try_cast("timestamp_ntz")
    zoned = local - F.make_dt_interval(mins=offset)
    iso_like = F.substring(text, 5, 1) == "-"
    # Every form begins with a digit; most other texts need no pattern.
    return F.when(F.substring(text, 1, 1).between("0", "9"), (
        F.when(iso_like & text.rlike(ISO_TIME), text.try_cast("timestamp_ntz"))
        .when(iso_like & text.rlike(ZONED_TIME), zoned)
        .when(text.contains("/") & text.rlike(SLASH_DATE), F.try_to_date(text, "M/d/yyyy").cast("timestamp_ntz"))
        .when(text.contains("/") & text.rlike(YEAR_FIRST_DATE), F.try_to_date(text, "yyyy/M/d").cast("timestamp_ntz"))
        .when(text.contains("-") & text.rlike(NAMED_MONTH_DATE), F.try_to_date(_month_number(text), "d-M-yyyy").cast("timestamp_ntz"))
    ))


def _month_number(text: Column) -> Column:
    """``05-jan-2024`` as ``05-1-2024``; an unknown month stays a word and is no date."""
    parts, months = F.split(F.lower(text), "-"), [m.lower() for m in MONTHS]
    place = F.array_position(F.array(*[F.lit(m) for m in months]), F.get(parts, F.lit(1)))
    month = F.when(place > 0, place.cast("string")).otherwise(F.get(parts, F.lit(1)))
    return F.concat_ws("-", F.get(parts, F.lit(0)), month, F.get(parts, F.lit(2)))


def try_date(text: Column) -> Column:
    return try_time(text).cast("date")


def try_flag(text: Column) -> Column:
    """A boolean from true/false, 1/0, yes/no or y/n in any case."""
    low = F.lower(text)
    return F.when(low.isin(*TRUE_TEXTS), F.lit(True)).when(low.isin(*FALSE_TEXTS), F.lit(False))


def number_size(type_name: str) -> tuple[int, int]:
    """Digits and scale of ``NUMBER``, ``NUMBER(p)`` or ``NUMBER(p,s)``."""
    size = type_name.partition("(")[2].rstrip(")")
    digits, _, scale = size.partition(",")
    return int(digits or 38), int(scale or 0)


def cast_to(text: Column, type_name: str) -> Column:
    """Cast text to a warehouse type name such as ``NUMBER(10)``, ``NUMBER(12,2)`` or ``VARCHAR(50)``.

    ``NUMBER(p)`` takes numbers of up to p digits, rounded; a longer one is no value of it. Up to 18
    digits fit a long; ``NUMBER`` without that bound stays a 38-digit decimal. ``NUMBER(p,s)`` is a decimal.
    """
    kind = type_name.upper().partition("(")[0]
    if kind == "NUMBER":
        digits, scale = number_size(type_name)
        if scale:
            return try_number(text, digits, scale)
        if digits > 18:
            return try_number(text, digits).cast("decimal(38,0)")
        # Most whole numbers are digits alone, which need no decimal.
        plain = text.rlike(f"^[0-9]{{1,{digits}}}$")
        return F.when(plain, text.try_cast("bigint")).otherwise(try_number(text, digits).cast("bigint"))
    casts = {
        "FLOAT": try_double,
        "DATE": try_date,
        "TIMESTAMP": try_time,
        "TIMESTAMP_NTZ": try_time,
        "BOOLEAN": try_flag,
        "VARCHAR": lambda c: c,
    }
    return casts[kind](text)


LEADING_ZERO = "^[+-]?0[0-9]"


def whole_digits(number: Column) -> Column:
    """Digits before the point of a number's text, leading zeros not counted; null for one with an exponent."""
    digits = F.regexp_extract(number, "^[+-]?0*([0-9]*)", 1)
    return F.when(~F.lower(number).contains("e"), F.length(digits))


def fraction_digits(number: Column) -> Column:
    """Digits after the point of a number's text, trailing zeros not counted; null for one with an exponent."""
    digits = F.rtrim(F.regexp_extract(number, "[.]([0-9]*)$", 1), F.lit("0"))
    return F.when(~F.lower(number).contains("e"), F.length(digits))


def changed_by_double(number: Column) -> Column:
    """True where a double does not have all digits of a number's text, or the text has leading zeros.

    Up to 15 significant digits always survive. Beyond them the decimal values of both are compared; what is too
    long to compare, and what is beyond the largest double, has changed.
    """
    value = number.try_cast("double")
    mantissa = F.regexp_replace(number, "^[+-]|[eE].*$", "")
    digits = F.regexp_replace(F.regexp_replace(mantissa, "[.]", ""), "^0+|0+$", "")
    scale = F.regexp_replace(mantissa, "^[0-9]*[.]?", "")
    whole = number.try_cast("decimal(38,0)") != value.try_cast("decimal(38,0)")
    broken = number.try_cast("decimal(38,18)") != value.try_cast("decimal(38,18)")
    differs = F.coalesce(F.when(scale == "", whole).otherwise(broken), F.lit(True))
    infinite = F.abs(value) == float("inf")
    # A text of up to 15 characters has no more digits; most are that short.
    return number.rlike(LEADING_ZERO) | infinite | F.when(F.length(number) > 15, (F.length(digits) > 15) & differs).otherwise(F.lit(False))


def changed_by_cast(text: Column, type_name: str) -> Column:
    """True where a value survives the cast to ``type_name`` in another form.

    A whole number loses a fraction or leading zeros, a decimal digits beyond its scale, a floating number digits
    beyond its precision, a date its time of day.
    """
    kind = type_name.upper().partition("(")[0]
    value = cast_to(text, type_name)
    if kind == "NUMBER":
        _, scale = number_size(type_name)
        if scale:
            longer = F.coalesce(fraction_digits(text) > scale, text.try_cast("double") != value.cast("double"))
            return value.isNotNull() & (text.rlike(LEADING_ZERO) | longer)
        # Digits alone have no fraction to lose.
        exact = F.when(~is_integer(text), try_number(text, 38, 10) != value.cast("decimal(38,10)"))
        return value.isNotNull() & (text.rlike(LEADING_ZERO) | F.coalesce(exact, F.lit(False)))
    if kind == "FLOAT":
        return value.isNotNull() & changed_by_double(text)
    if kind == "DATE":
        return value.isNotNull() & (try_time(text) != value.cast("timestamp_ntz"))
    return F.lit(False)


def spark_type(type_name: str) -> str:
    """The Spark type a warehouse type name maps to."""
    kind = type_name.upper().partition("(")[0]
    if kind == "NUMBER":
        digits, scale = number_size(type_name)
        return f"decimal({digits},{scale})" if scale else "bigint" if digits <= 18 else "decimal(38,0)"
    return {
        "FLOAT": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
        "TIMESTAMP_NTZ": "timestamp_ntz", "BOOLEAN": "boolean", "VARCHAR": "string",
    }[kind]


def declared_type(type_name: str) -> str:
    """The type a table's column is declared with: as :func:`spark_type`, but a text keeps its length."""
    return type_name.lower() if type_name.upper().startswith("VARCHAR(") else spark_type(type_name)


def double_text(value: Column) -> Column:
    """The text of a double without an exponent between 1e-4 and 1e16, as in ``12345678.9``.

    Not a number is a missing value.
    """
    text, size = value.cast("string"), F.abs(value)
    exponent = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    digits = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(exponent, plain).when(~F.isnan(value), text)


def text_of(df: DataFrame, column: str) -> Column:
    """The text form of one column, whatever its type."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return double_text(value.cast("double"))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text; ``nan``, as a text or from a double, becomes null."""
    def texts(field: T.StructField) -> Column:
        text = text_of(df, field.name)
        if isinstance(field.dataType, T.StringType):
            text = F.when(text != "nan", text)
        return text.alias(field.name)

    return df.select(*[texts(f) for f in df.schema])
