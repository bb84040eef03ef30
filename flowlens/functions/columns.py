"""Column expressions shared by the operators. All stay inside Catalyst."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

INF = float("inf")

# Accepted names of window sizes, and microseconds per unit.
SIZE_ALIASES = {"1min": "1 minute", "1h": "1 hour", "1hour": "1 hour"}
UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def require(df: DataFrame, columns, numeric=(), datetime=()) -> None:
    """Raise ValueError unless the schema holds the columns with the wanted kinds."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in [*columns, *numeric, *datetime] if c not in types]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    wrong = [c for c in numeric if not isinstance(types[c], T.NumericType)]
    wrong += [c for c in datetime if not isinstance(types[c], (T.TimestampType, T.TimestampNTZType))]
    if wrong:
        raise ValueError(f"columns of the wrong type: {wrong}")


def schema_contract(df: DataFrame, columns=(), numeric=(), datetime=()) -> DataFrame:
    """One row per wanted column: name, present, type_right (always true for columns of any type)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds = [*((c, None) for c in columns), *((c, T.NumericType) for c in numeric),
             *((c, (T.TimestampType, T.TimestampNTZType)) for c in datetime)]
    rows = [(c, c in types, c in types and (kind is None or isinstance(types[c], kind))) for c, kind in kinds]
    return df.sparkSession.createDataFrame(rows, "name string, present boolean, type_right boolean")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def finite(col: Column) -> Column:
    """The value as double, with NaN and both infinities turned into NULL."""
    value = col.cast("double")
    return F.when(F.abs(value) < F.lit(INF), value)


def ratio(top, bottom) -> Column:
    """top / bottom, NULL where the bottom is 0 or missing."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top, bottom) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def any_of(conditions) -> Column:
    """OR over many conditions, built as a balanced tree to keep the plan shallow."""
    conditions = list(conditions)
    if not conditions:
        return F.lit(False)
    while len(conditions) > 1:
        conditions = [
            reduce(lambda a, b: a | b, conditions[i:i + 2]) for i in range(0, len(conditions), 2)
        ]
    return conditions[0]


def size_micros(size: str) -> int:
    """Microseconds of a window size such as '1min', '1h', '30 seconds' or '1 day'."""
    text = SIZE_ALIASES.get(size, size).strip().lower()
    found = re.fullmatch(r"(\d+)\s*([a-z]+?)s?", text)
    unit = {"min": "minute", "h": "hour", "sec": "second", "s": "second", "d": "day"}
    name = found and unit.get(found.group(2), found.group(2))
    if not found or name not in UNIT_MICROS:
        raise ValueError(f"not a window size: {size!r}")
    return int(found.group(1)) * UNIT_MICROS[name]


def micros(df: DataFrame, name: str = "StartTime") -> Column:
    """A timestamp column as microseconds since the epoch, for either timestamp type."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(F.col(name))


def bucket_number(df: DataFrame, size: str, name: str = "StartTime") -> Column:
    """Index of the tumbling window a row falls into; NULL time gives NULL."""
    width = size_micros(size)
    at = micros(df, name)
    return ((at - F.pmod(at, F.lit(width))) / F.lit(width)).cast("long")


def time_bucket(df: DataFrame, size: str = "1min", name: str = "StartTime") -> Column:
    """Start of the tumbling window a row falls into, in the column's own type.

    ``F.window`` would drop rows without a time, so the floor is plain arithmetic.
    """
    width = size_micros(size)
    at = micros(df, name)
    start = at - F.pmod(at, F.lit(width))
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", start, F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.timestamp_micros(start)


def pair_key(src: str = "SrcAddr", dst: str = "DstAddr") -> tuple[Column, Column]:
    """Undirected address pair as two ordered columns; both NULL if either address is."""
    whole = F.col(src).isNotNull() & F.col(dst).isNotNull()
    return (F.when(whole, F.least(src, dst)), F.when(whole, F.greatest(src, dst)))


# Address blocks that are private, loopback, link-local or otherwise
# not global, as (network, prefix length).
PRIVATE_V4 = [
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("127.0.0.0", 8), ("169.254.0.0", 16),
    ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24), ("192.168.0.0", 16),
    ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("240.0.0.0", 4),
]
PRIVATE_V6 = r"^(::1?$|f[cd][0-9a-f]{2}:|fe[89ab][0-9a-f]:|2001:0?db8:|100::)"


def is_private_ip(address: Column) -> Column:
    """True for private, loopback and link-local addresses; garbage and NULL give False."""
    text = F.trim(address.cast("string"))
    parts = F.split(text, r"\.")
    octets = [F.try_element_at(parts, F.lit(i + 1)).try_cast("int") for i in range(4)]
    dotted = text.rlike(r"^(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$")
    in_range = reduce(lambda a, b: a & b, [o <= 255 for o in octets])
    number = reduce(lambda a, b: a * 256 + b, [o.cast("long") for o in octets])
    blocks = []
    for network, length in PRIVATE_V4:
        low = reduce(lambda a, b: a * 256 + int(b), network.split("."), 0)
        blocks.append(number.between(low, low + (1 << (32 - length)) - 1))
    v6 = F.lower(text).rlike(PRIVATE_V6)
    return F.coalesce((dotted & in_range & any_of(blocks)) | v6, F.lit(False))
