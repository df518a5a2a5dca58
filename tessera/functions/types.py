"""The semantic type lattice: value tests and guarded casts.

Every cast is guarded by the type's pattern, so a value is converted only
when its whole text is an unambiguous literal of the target type; engines
differ on the edge cases (``'1e3'`` to bigint, ``'1.5f'`` to double).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import exact as E
from tessera.functions.text import go_trim

# The semantic types in tie-break order (earlier wins a tie),
# the regular expressions that a trimmed non-null string must match as a
# whole, and the Spark storage type of each. The patterns use only the
# syntax shared by Java and RE2 regular expressions.
SEMANTIC_TYPES = [
    "boolean", "latitude", "longitude", "integer", "real", "dateTime",
    "url", "email", "image", "place", "categorical", "unknown",
]
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
TIME = r"[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?"
PATTERNS = {
    "boolean": r"^(?i:true|false)\z",
    "integer": r"^[+-]?[0-9]+\z",
    "real": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z",
    "date": DATE + r"\z",
    "dateTime": DATE + "(" + TIME + r")?\z",
    "url": r"^(?i:https?|ftp)://[^\s/?#]+[^\s]*\z",
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}\z",
    "image": r"(?i)[.](tif|tiff|png|jpg|jpeg)\z",
}
STORAGE_TYPES = {
    "boolean": "boolean", "latitude": "double", "longitude": "double",
    "integer": "bigint", "real": "double", "dateTime": "timestamp_ntz",
    "url": "string", "email": "string", "image": "string", "place": "string",
    "categorical": "string", "unknown": "string",
}
# Name hints and value ranges of the coordinate types.
COORD_RULES = {"latitude": ("lat", 90.0), "longitude": ("lon", 180.0)}
# Storage types that a cast can fail for.
CAST_TARGETS = ("bigint", "double", "boolean", "date", "timestamp_ntz")
NUMERIC_STORAGE = ("bigint", "double")


def is_number(storage: str) -> bool:
    """A storage type of numbers, decimals of any size included."""
    return storage in NUMERIC_STORAGE or storage.startswith("decimal")


PRIORITY = {t: i for i, t in enumerate(SEMANTIC_TYPES)}
SCORED_TYPES = [t for t in SEMANTIC_TYPES if t not in ("place", "categorical", "unknown")]


def storage_of(semantic_type: Column, n_time: Column) -> Column:
    """Storage type of a suggested type. A dateTime column is a date unless
    some value has a time of day."""
    st = F.create_map(*[x for t, s in STORAGE_TYPES.items() for x in (F.lit(t), F.lit(s))])
    return F.when((semantic_type == "dateTime") & (F.coalesce(n_time, F.lit(0)) == 0), F.lit("date")).otherwise(st[semantic_type])


def matches_type(v: Column, semantic_type: str, name: Column) -> Column:
    """Boolean test of a trimmed string against one semantic type.

    Coordinates need a real value in range and a column name that carries
    the hint (``lat`` / ``lon``). ``name`` is the column's name as a column,
    for long (col, v) data where one expression serves every column.
    """
    if semantic_type in COORD_RULES:
        hint, bound = COORD_RULES[semantic_type]
        num = F.when(v.rlike(PATTERNS["real"]), v.try_cast("double"))
        return F.coalesce(F.lower(name).contains(hint) & (F.abs(num) <= F.lit(bound)), F.lit(False))
    return F.coalesce(v.rlike(PATTERNS[semantic_type]), F.lit(False))


def has_time(v: Column) -> Column:
    """A dateTime literal with a time of day."""
    return F.coalesce(v.rlike(PATTERNS["dateTime"]) & ~v.rlike(PATTERNS["date"]), F.lit(False))


def kept_cast(v: Column, target: str) -> Column:
    """Whether casting the trimmed text to a storage type keeps its value."""
    if target == "bigint":
        return F.coalesce(F.when(v.rlike(PATTERNS["integer"]), E.kept_by_bigint(v)), F.lit(False))
    if target == "double":
        return F.coalesce(F.when(v.rlike(PATTERNS["real"]), E.kept_by_double(v)), F.lit(False))
    return guarded_cast(v, target).isNotNull()


def guarded_cast(v: Column, target: str) -> Column:
    """Cast a string column to a Spark type, null unless its pattern holds.

    ``target`` is a Spark type name (bigint, double, decimal(p,s), boolean,
    date, timestamp_ntz, string) or a semantic type name.
    """
    target = STORAGE_TYPES.get(target, target)
    s = go_trim(v.cast("string"))
    if target in ("bigint", "int", "long", "integer"):
        return F.when(s.rlike(PATTERNS["integer"]), s.try_cast(target if target != "integer" else "bigint"))
    if target in ("double", "float") or target.startswith("decimal"):
        return F.when(s.rlike(PATTERNS["real"]), s.try_cast(target))
    if target == "boolean":
        return F.when(s.rlike(PATTERNS["boolean"]), F.lower(s) == "true")
    if target == "date":
        return F.when(s.rlike(PATTERNS["date"]), s.try_cast("date"))
    if target == "timestamp_ntz":
        return F.when(s.rlike(PATTERNS["dateTime"]), s.try_cast("timestamp_ntz"))
    return v.cast("string")
