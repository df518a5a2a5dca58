"""DuckDB SQL text for the oracles. The type tests, casts and null tokens are
written here from their contract, apart from the operators' own patterns, so
that a mistake there is not repeated here. Only strings are built; nothing
runs."""

from __future__ import annotations

# The lattice in tie-break order, white space as Unicode has it,
# and the strings that mean "no value".
LATTICE = ["boolean", "latitude", "longitude", "integer", "real", "dateTime", "url", "email", "image", "place",
           "categorical", "unknown"]
SPACE = r"[\t\n\x{0b}\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NO_VALUE = ("", "NA", "N/A", "NULL", "NONE", "?")
SCORED = LATTICE[:9]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_expr(c: str) -> str:
    return f"regexp_replace(cast({c} as varchar), {q(rf'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def clean_expr(c: str) -> str:
    toks = ", ".join(q(t) for t in NO_VALUE)
    return f"case when upper({trim_expr(c)}) in ({toks}) then null else {trim_expr(c)} end"


def _full(v: str, pattern: str) -> str:
    return f"coalesce(regexp_full_match({v}, {q(pattern)}), false)"


REAL = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
DAY = r"\d{4}-\d{2}-\d{2}"
CLOCK = r"[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"


def match_expr(v: str, ty: str, col: str) -> str:
    """Whether the trimmed text ``v`` of a column is of a type, as a whole."""
    if ty in ("latitude", "longitude"):
        hint, bound = {"latitude": ("lat", 90), "longitude": ("lon", 180)}[ty]
        if hint not in col.lower():
            return "false"
        return f"coalesce({_full(v, REAL)} and abs(try_cast({v} as double)) <= {bound}, false)"
    if ty == "boolean":
        return f"coalesce(lower({v}) in ('true', 'false'), false)"
    if ty == "image":
        return f"coalesce(regexp_matches(lower({v}), {q(r'\.(tif|tiff|png|jpg|jpeg)$')}), false)"
    return _full(v, {"integer": r"[+-]?\d+", "real": REAL, "dateTime": f"{DAY}({CLOCK})?",
                     "url": r"(?i:https?|ftp)://[^\s/?#]\S*", "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"}[ty])


def cast_expr(v: str, target: str) -> str:
    s = trim_expr(v)
    if target == "boolean":
        return f"case when lower({s}) in ('true', 'false') then lower({s}) = 'true' end"
    test = {"bigint": (r"[+-]?\d+", "bigint"), "double": (REAL, "double"), "date": (DAY, "date"),
            "timestamp_ntz": (f"{DAY}({CLOCK})?", "timestamp")}.get(target)
    if test is None:
        return f"cast({v} as varchar)"
    return f"case when {_full(s, test[0])} then try_cast({s} as {test[1]}) end"


def scores_sql(src: str, cols: list[str], dataset_id: str | None = None) -> str:
    """Long type scores (col, semantic_type, n, n_match, probability)."""
    parts = []
    ds = f"{q(dataset_id)} as dataset_id, " if dataset_id else ""
    for c in cols:
        for ty in SCORED:
            parts.append(
                f"select {ds}{q(c)} as col, {q(ty)} as semantic_type, count(v) as n, m as n_match, "
                f"round(case when count(v) > 0 then m / count(v) else 0.0 end, 6) as probability from ("
                f"select v, count_if(v is not null and {match_expr('v', ty, c)}) over ()::bigint as m "
                f"from (select {trim_expr(c)} as v from {src})) group by m")
    return "\nunion all\n".join(parts)


def priority_values() -> str:
    rows = ", ".join(f"({q(t)}, {p})" for p, t in enumerate(LATTICE))
    return f"(values {rows}) as pr(semantic_type, priority)"


def storage_values() -> str:
    numbers = {"boolean": "boolean", "latitude": "double", "longitude": "double", "integer": "bigint", "real": "double",
               "dateTime": "timestamp_ntz"}
    rows = ", ".join(f"({q(t)}, {q(numbers.get(t, 'string'))})" for t in LATTICE)
    return f"(values {rows}) as st(semantic_type, storage)"


def best_sql(scores: str, keys: str = "col") -> str:
    """The type with most matches per column, from a scores relation."""
    return (f"select {keys}, semantic_type, n, n_match, probability from (select s.*, row_number() over "
            f"(partition by {keys} order by n_match desc, pr.priority asc) as rn "
            f"from {scores} s join {priority_values()} using (semantic_type)) where rn = 1")


def gate_expr(threshold: str = "0.8") -> str:
    """Exact in whole numbers: n_match / n against the threshold."""
    num, den = int(float(threshold) * 1000), 1000
    return f"case when n > 0 and n_match * {den} >= n * {num} then semantic_type else 'unknown' end"


def distinct_sql(src: str, cols: list[str], dataset_id: str | None = None) -> str:
    ds = f"{q(dataset_id)} as dataset_id, " if dataset_id else ""
    return "\nunion all\n".join(
        f"select {ds}{q(c)} as col, count(*) as n_rows, count(distinct {trim_expr(c)}) as n_distinct, "
        f"count_if({_full(trim_expr(c), DAY + CLOCK)})::bigint as n_time from {src}"
        for c in cols)


def classify_sql(best: str, distinct: str, keys: str = "col", ratio: float = 0.05) -> str:
    """Final suggested type with the gate and the categorical step."""
    return (f"select {keys}, case when gated = 'unknown' and n_distinct >= 1 and n_distinct <= n_rows * {ratio} "
            f"then 'categorical' else gated end as semantic_type, probability, n_time from ("
            f"select b.*, d.n_rows, d.n_distinct, d.n_time, {gate_expr()} as gated from {best} b join {distinct} d using ({keys}))")


def casts_sql(src: str, cols: list[str], dataset_id: str) -> str:
    """Per column: values, and values that cast to each storage type."""
    return "\nunion all\n".join(
        f"select {q(dataset_id)} as dataset_id, {q(c)} as col, count({c}) as n_non_null, "
        + ", ".join(f"count({cast_expr(c, t)}) as k_{t}" for t in ("bigint", "double", "boolean", "date", "timestamp_ntz"))
        + f" from {src}" for c in cols)


def verified_sql(cls: str, casts: str) -> str:
    """(dataset_id, col, semantic_type, probability, n_non_null, n_cast,
    accepted, storage) from the classified columns and their cast counts."""
    return f"""select *, n_non_null = n_cast as accepted from (
  select dataset_id, col, semantic_type, probability, n_non_null, storage,
    case storage when 'bigint' then k_bigint when 'double' then k_double when 'boolean' then k_boolean
         when 'date' then k_date when 'timestamp_ntz' then k_timestamp_ntz else n_non_null end as n_cast
  from (select c.*, k.* exclude (dataset_id, col), case when semantic_type = 'dateTime' and n_time = 0 then 'date' else st.storage end as storage
        from {cls} c join {casts} k using (dataset_id, col) join {storage_values()} using (semantic_type)))"""


def unpivot_sql(src: str, cols: list[str], value: str = "double", extra: str = "") -> str:
    """(col, v) non-null long form."""
    return "\nunion all\n".join(
        f"select {extra}{q(c)} as col, cast({c} as {value}) as v from {src} where {c} is not null" for c in cols)


DUCK_TYPE_TO_SPARK = {"BIGINT": "bigint", "VARCHAR": "string", "INTEGER": "int", "DOUBLE": "double",
                      "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "BOOLEAN": "boolean", "DATE": "date"}


def spark_type_case(col: str) -> str:
    whens = " ".join(f"when {q(d)} then {q(s)}" for d, s in DUCK_TYPE_TO_SPARK.items())
    return f"case {col} {whens} else lower({col}) end"
