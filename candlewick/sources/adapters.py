"""From landed JSON payloads to typed rows.

Payload tables have the columns ``symbol`` and ``payload`` (one API response
as text), and ``position`` if a symbol has several. Every adapter yields raw
records with ``__symbol__``, ``__date__`` and their place of arrival
(``__payload__``, ``__record__``); the column mapping, which is data, then
names and casts them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import day_from_millis

ARRAYS_SCHEMA = "prices array<array<double>>, market_caps array<array<double>>, total_volumes array<array<double>>"
KLINES_SCHEMA = "array<array<string>>"
SERIES_SCHEMA = (
    "`Time Series (Daily)` map<string, struct<`1. open`:string, `2. high`:string, "
    "`3. low`:string, `4. close`:string, `5. volume`:string>>"
)

# Position of each field in a kline.
KLINE_FIELDS = {
    "open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "close_time": 6,
    "quote_volume": 7, "number_of_trades": 8, "taker_buy_base_vol": 9, "taker_buy_quote_vol": 10,
}


#: Place of arrival of a record: of two with one key the later one wins.
ARRIVAL = ["__payload__", "__record__"]


def _position(payloads: DataFrame) -> Column:
    return (F.col("position") if "position" in payloads.columns else F.lit(0)).cast("bigint").alias("__payload__")


def _arrays(payload: Column) -> Column:
    return F.from_json(payload, ARRAYS_SCHEMA)


def _zipped(parsed: Column) -> Column:
    """The three arrays side by side, cut to the shortest; absent ones are empty."""
    empty = F.array().cast("array<array<double>>")
    parts = {c: F.coalesce(parsed[c], empty) for c in ("prices", "market_caps", "total_volumes")}
    shortest = F.least(*[F.size(p) for p in parts.values()])
    return F.arrays_zip(*[F.slice(p, F.lit(1), shortest).alias(c) for c, p in parts.items()])


def parse_parallel_arrays(payloads: DataFrame) -> DataFrame:
    """Three parallel arrays of ``[millis, value]`` -> daily rows."""
    rows = payloads.select(
        "symbol", _position(payloads), F.posexplode(_zipped(_arrays(F.col("payload")))).alias("__record__", "_r")
    )
    return rows.select(
        F.col("symbol").alias("__symbol__"),
        day_from_millis(F.get("_r.prices", F.lit(0))).alias("__date__"),
        F.get("_r.prices", F.lit(1)).alias("price"),
        F.get("_r.market_caps", F.lit(1)).alias("market_cap"),
        F.get("_r.total_volumes", F.lit(1)).alias("total_volume"),
        *ARRIVAL,
    )


def parse_klines(payloads: DataFrame) -> DataFrame:
    """Arrays of positional fields, numbers as text -> daily rows."""
    rows = payloads.select(
        "symbol", _position(payloads), F.posexplode(F.from_json("payload", KLINES_SCHEMA)).alias("__record__", "_k")
    )
    millis = F.get("_k", F.lit(0)).try_cast("bigint")
    return rows.select(
        F.col("symbol").alias("__symbol__"),
        day_from_millis(millis).alias("__date__"),
        *[F.get("_k", F.lit(i)).alias(name) for name, i in KLINE_FIELDS.items()],
        *ARRIVAL,
    )


def _series(payload: Column) -> Column:
    return F.from_json(payload, SERIES_SCHEMA)["Time Series (Daily)"]


def parse_series_map(payloads: DataFrame) -> DataFrame:
    """A map of date text -> fields, all dates of it."""
    return _series_rows(payloads, F.array_sort(F.map_keys("_series")))


def parse_newest_series(payloads: DataFrame, newest: int) -> DataFrame:
    """The newest dates of each map, as a fetch window asks for.

    Dates are compared as text and counted before they are validated, so an
    invalid one still uses up a slot. All of it happens inside the payload's
    own row: nothing is shuffled.
    """
    keys = F.slice(F.reverse(F.array_sort(F.map_keys("_series"))), 1, newest)
    return _series_rows(payloads, keys)


def _series_rows(payloads: DataFrame, keys: Column) -> DataFrame:
    rows = (
        payloads.select("symbol", _position(payloads), _series(F.col("payload")).alias("_series"))
        .select("symbol", "__payload__", "_series", F.posexplode(keys).alias("__record__", "_key"))
        .select("symbol", *ARRIVAL, "_key", F.col("_series")[F.col("_key")].alias("_v"))
    )
    day = F.when(F.col("_key").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date("_key", "yyyy-M-d"))
    return rows.select(
        F.col("symbol").alias("__symbol__"),
        day.alias("__date__"),
        F.col("_v")["1. open"].alias("open"),
        F.col("_v")["2. high"].alias("high"),
        F.col("_v")["3. low"].alias("low"),
        F.col("_v")["4. close"].alias("close"),
        F.col("_v")["5. volume"].alias("volume"),
        *ARRIVAL,
    ).filter(F.col("__date__").isNotNull())


def _arrays_error(payload: Column) -> Column:
    parsed = _arrays(payload)
    return F.when(parsed["prices"].isNull(), "no prices in response").when(
        F.size(_zipped(parsed)) == 0, "prices but no usable records"
    )


def _klines_error(payload: Column) -> Column:
    parsed = F.from_json(payload, KLINES_SCHEMA)
    return F.when(parsed.isNull(), "unexpected response").when(F.size(parsed) == 0, "empty kline list")


def _series_error(payload: Column) -> Column:
    series = _series(payload)
    said = F.coalesce(*[F.get_json_object(payload, f"$['{k}']") for k in ("Note", "Information", "Error Message")])
    return F.when(
        series.isNull() | (F.size(series) == 0), F.concat_ws(": ", F.lit("no data in response"), said)
    )


Adapter = Callable[..., DataFrame]

ADAPTERS: dict[str, tuple[Adapter, Callable[[Column], Column]]] = {
    "coingecko": (parse_parallel_arrays, _arrays_error),
    "binance": (parse_klines, _klines_error),
    "alpha_vantage": (parse_series_map, _series_error),
}


def parse(source: str, payloads: DataFrame) -> DataFrame:
    """Parse payloads with the adapter of ``source``."""
    if source not in ADAPTERS:
        raise ValueError(f"no adapter for source {source!r}")
    return ADAPTERS[source][0](payloads)


def payload_errors(source: str, payloads: DataFrame) -> DataFrame:
    """Symbols whose payload cannot be used at all, and why."""
    if source not in ADAPTERS:
        raise ValueError(f"no adapter for source {source!r}")
    why = ADAPTERS[source][1](F.col("payload"))
    return payloads.select(F.col("symbol").alias("source_symbol"), why.alias("error_message")).filter(
        F.col("error_message").isNotNull()
    )


_NUMBER_SUFFIX = r"^\s*[+-]?[0-9.].*[dDfF]\s*$"


def _cast(df: DataFrame, field: str, data_type: str) -> Column:
    col = F.col(f"`{field}`")
    if data_type == "float":
        value = col.try_cast("double")
        if df.schema[field].dataType.typeName() == "string":
            # a Java number suffix such as 1.5d is not a number here
            value = F.when(~col.rlike(_NUMBER_SUFFIX), value)
        return value
    if data_type in ("int", "bigint"):
        if df.schema[field].dataType.typeName() == "string":
            # 12.5 as text is not an integer
            return F.when(col.rlike(r"^\s*[+-]?\d+\s*$"), col.try_cast("bigint"))
        return col.try_cast("bigint")
    return col


def apply_mapping(
    df: DataFrame, mapping: list[tuple[str, str, str]], *, required: list[str] | None = None, carry: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) rows after renaming and casting by ``mapping``.

    Mapping rows are (source field, target column, type); fields the records
    do not have are left out. A value that is present but does not cast
    sends its row to quarantine, with the fields at fault; NULL stays NULL,
    except in a ``required`` target column, where it is a fault as well.
    Columns of ``carry`` go along unchanged.
    """
    must, carry = set(required or []), list(carry or [])
    present = [(f, t, k) for f, t, k in mapping if f in df.columns]
    casts = {t: _cast(df, f, k) for f, t, k in present}
    faults = F.filter(
        F.array(
            *[
                F.when((casts[t].isNull() if t in must else F.col(f"`{f}`").isNotNull() & casts[t].isNull()), F.lit(f))
                for f, t, _ in present
            ]
        ),
        lambda x: x.isNotNull(),
    )
    marked = df.withColumn("_faults", faults)
    good = marked.filter(F.size("_faults") == 0).select(*[casts[t].alias(t) for _, t, _ in present], *carry)
    bad = marked.filter(F.size("_faults") > 0).select(
        *[F.col(f"`{f}`") for f, _, _ in present], *carry, F.array_join("_faults", ", ").alias("bad_fields")
    )
    return good, bad
