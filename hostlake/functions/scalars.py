"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the monitored system's conventions) ----------
# Numeric-text guard used before every text -> double cast of history values.
NUMERIC_TEXT_PATTERN = r"^-?[0-9]+(\.[0-9]+)?\z"
# History value_type codes and their names; 0 and 3 are the numeric types.
VALUE_TYPE_NAMES = {
    0: "numeric_float",
    1: "character",
    2: "log",
    3: "numeric_unsigned",
    4: "text",
}
NUMERIC_VALUE_TYPES = (0, 3)
UNKNOWN_VALUE_TYPE_NAME = "unknown"
# Value written instead of a secret macro value.
MASKED_SECRET = "***MASKED***"
# ---------------------------------------------------------------------------

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_numeric(value: str | Column) -> Column:
    """Text -> double only when the text is a plain decimal number, else NULL.

    The regex decides, not the cast: '1e3', 'NaN', ' 1 ', '1d' and '12\\n' all
    give NULL. ``\\z`` (not ``$``) so a trailing newline is rejected.
    """
    v = c(value)
    return F.when(v.rlike(NUMERIC_TEXT_PATTERN), v.try_cast("double"))


def safe_numeric_typed(value: str | Column, value_type: str | Column) -> Column:
    """``safe_numeric`` restricted to the numeric history value types (0, 3)."""
    return F.when(c(value_type).isin(*NUMERIC_VALUE_TYPES), safe_numeric(value))


def clock_to_ntz(clock: str | Column) -> Column:
    """Unix seconds -> TIMESTAMP_NTZ (UTC wall time), independent of session zone."""
    return F.timestamp_add("SECOND", c(clock), F.expr(EPOCH_NTZ))


def utc_ntz(ts: str | Column) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding its UTC wall time, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c(ts)), F.expr(EPOCH_NTZ))


def ntz_to_clock(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ -> unix seconds (floor for times after 1970)."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), c(ts))


def value_type_name(value_type: str | Column) -> Column:
    """Decode a value_type code; unknown codes give 'unknown'."""
    vt = c(value_type).cast("int")
    expr = None
    for code, name in VALUE_TYPE_NAMES.items():
        expr = (F.when(vt == code, F.lit(name)) if expr is None else expr.when(vt == code, F.lit(name)))
    return expr.otherwise(F.lit(UNKNOWN_VALUE_TYPE_NAME))


def round_half_up(x: str | Column, scale: int = 1) -> Column:
    """PostgreSQL ``round(numeric, n)``: exact decimal half-up, returned as double."""
    return F.round(c(x).cast("decimal(38,9)"), scale).cast("double")


def pct(part: str | Column, whole: str | Column, scale: int = 1) -> Column:
    """``round(100.0 * part / nullif(whole, 0), scale)``."""
    whole_c = c(whole)
    return F.when(whole_c != 0, round_half_up(F.lit(100.0) * c(part) / whole_c, scale))


def clean_text(s: str | Column) -> Column:
    """Bulk-load text cleaning: tab, newline and CR become a space."""
    return F.translate(c(s), "\t\n\r", "   ")


def sanitize_run_id(s: str | Column) -> Column:
    """File-name-safe run id: ':', '+' and '/' become '_'."""
    return F.translate(c(s), ":+/", "___")


def iso_utc(ts: str | Column) -> Column:
    """ISO-8601 UTC text with a 'Z' suffix (microseconds kept)."""
    return F.date_format(c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def utc_time(text: str | Column) -> Column:
    """A time text as UTC timestamp without zone, whatever the session's zone: an offset or 'Z' in the text is heeded, a
    text without one is UTC; NULL for other texts."""
    t = F.trim(c(text))
    zoned = F.when(t.rlike(r"(Z|[+-]\d{2}(:?\d{2})?)$") & t.contains(":"), t).otherwise(F.concat(t, F.lit("Z")))
    micros = F.unix_micros(zoned.try_cast("timestamp"))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def iso_utc_seconds(ts: str | Column) -> Column:
    """ISO-8601 UTC text at second precision, 'Z' suffix."""
    return F.date_format(c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_parts(ts: str | Column) -> list[Column]:
    """y / m / d partition columns of a timestamp."""
    t = c(ts)
    return [
        F.date_format(t, "yyyy").alias("y"),
        F.date_format(t, "MM").alias("m"),
        F.date_format(t, "dd").alias("d"),
    ]


def json_map(text: str | Column) -> Column:
    """JSON object text -> map<string,string> with JSON-library semantics for
    duplicate keys: one entry per key, at its first position, holding the last
    value (``from_json`` alone keeps every duplicate and lookups see the first).
    Nested objects / arrays stay JSON text. The rewrite only runs on objects
    that do have duplicates."""
    def one(m):
        keys = F.map_keys(m)
        entries = F.map_entries(m)
        uniq = F.array_distinct(keys)
        dedup = F.map_from_arrays(
            uniq, F.transform(uniq, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))
        return F.when(F.size(keys) == F.size(uniq), m).otherwise(dedup)
    return bound(F.from_json(c(text), "map<string,string>"), one)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` refers to it (also inside lambdas,
    where Spark looks for no common expressions)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def allow_duplicate_json_keys(spark) -> None:
    """Let Variant parsing accept objects with duplicate keys (last value wins),
    as JSON libraries do, instead of treating such payloads as unparseable."""
    if str(spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false")).lower() != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
