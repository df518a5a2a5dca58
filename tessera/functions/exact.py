"""What a number written as text needs to be kept whole.

A number's *canonical form* is its significant digits and the place of its
point: ``1.50``, ``+1.5`` and ``15e-1`` are the same, (``15``, 1). A cast keeps a value
if the canonical form comes back the same. Zero-padded texts (``007``) are
no numbers in this sense: their zeros would not come back.

Per column the needs are joined in a lattice, by maxima and counts alone, so
that one aggregate over any split of the rows gives the least type that
keeps every value: bigint, double, ``decimal(p,s)``, or none (text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DECIMAL = 38  # fixed value: digits that a decimal holds
SAFE_DIGITS = 15  # fixed value: so many significant digits always survive a double
_BEYOND = 1 << 20  # stands for an exponent that no int holds
FAR = 300  # powers of ten well inside a double's range


def parts(text: Column) -> tuple[Column, Column, Column]:
    """Of a text that matches the ``real`` pattern: whether it is
    zero-padded, its significant digits, and the place of the point (the
    value is 0.digits times ten to that power; zero has no digits)."""
    low = F.lower(text)
    mantissa = F.ltrim(F.substring_index(low, "e", 1), F.lit("+-"))
    exponent = F.when(F.contains(low, F.lit("e")), F.coalesce(F.substring_index(low, "e", -1).try_cast("int"), F.lit(_BEYOND))).otherwise(F.lit(0))
    whole = F.substring_index(mantissa, ".", 1)
    digits = F.translate(mantissa, ".", "")
    led = F.ltrim(digits, F.lit("0"))
    core = F.rtrim(led, F.lit("0"))
    point = F.length(whole) + exponent - (F.length(digits) - F.length(led))
    padded = (F.length(whole) > 1) & F.startswith(whole, F.lit("0"))
    return padded, core, F.when(F.length(core) > 0, point).otherwise(F.lit(0))


def with_parts(df: DataFrame, text: Column, prefix: str = "") -> DataFrame:
    """``df`` with the ``parts`` of a text (or null) as columns padded, core
    and point, in steps: each is worked out once per row, however often the next refers to it."""
    df = df.withColumn("_low", F.lower(text))
    low, digits, led, core = F.col("_low"), F.col("_digits"), F.col("_led"), F.col(prefix + "core")
    df = df.withColumns({"_mantissa": F.ltrim(F.substring_index(low, "e", 1), F.lit("+-")),
                         "_exponent": F.when(F.contains(low, F.lit("e")), F.coalesce(F.substring_index(low, "e", -1).try_cast("int"), F.lit(_BEYOND))).otherwise(F.lit(0))})
    df = df.withColumns({"_whole": F.substring_index("_mantissa", ".", 1), "_digits": F.translate("_mantissa", ".", "")})
    df = df.withColumn("_led", F.ltrim(digits, F.lit("0")))
    df = df.withColumns({prefix + "padded": (F.length("_whole") > 1) & F.startswith("_whole", F.lit("0")), prefix + "core": F.rtrim(led, F.lit("0"))})
    point = F.length("_whole") + F.col("_exponent") - (F.length(digits) - F.length(led))
    df = df.withColumn(prefix + "point", F.when(F.length(core) > 0, point).otherwise(F.lit(0)))
    return df.drop("_low", "_mantissa", "_exponent", "_whole", "_digits", "_led")


def decimal_digits(core: Column, point: Column) -> tuple[Column, Column]:
    """Digits left and right of the point that a decimal needs."""
    return F.greatest(point, F.lit(1)), F.greatest(F.length(core) - point, F.lit(0))


def needs(text: Column) -> Column:
    """(whole, scale): digits left and right of the point that a decimal
    needs for the value; null for zero-padded text."""
    padded, core, point = parts(text)
    whole, scale = decimal_digits(core, point)
    return F.when(~padded, F.struct(whole.alias("whole"), scale.alias("scale")))


def double_holds(core: Column, point: Column, again: Column, at: Column) -> Column:
    """Whether a double gives back digits and point: 15 digits always come
    back; more do if the double's shortest text has the same (``again``, ``at``)."""
    short = (F.length(core) <= SAFE_DIGITS) & (F.abs(point) < FAR)
    return short | F.when(F.length(core) <= SAFE_DIGITS + 2, (again == core) & (at == point)).otherwise(F.lit(False))


def kept_by_double(text: Column) -> Column:
    """Whether a double gives the value back."""
    padded, core, point = parts(text)
    _, again, at = parts(text.try_cast("double").cast("string"))
    return ~padded & double_holds(core, point, again, at)


def kept_by_bigint(text: Column) -> Column:
    """The same for whole numbers and bigint."""
    unsigned = F.ltrim(text, F.lit("+-"))
    padded = (F.length(unsigned) > 1) & F.startswith(unsigned, F.lit("0"))
    return ~padded & text.try_cast("bigint").isNotNull()


def decimal_type(whole: Column, scale: Column) -> Column:
    """The name of the decimal type with so many digits; null if none has."""
    return F.when(whole + scale <= MAX_DECIMAL, F.concat(F.lit("decimal("), (whole + scale).cast("string"), F.lit(","), scale.cast("string"), F.lit(")")))
