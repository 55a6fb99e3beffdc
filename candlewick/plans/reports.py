"""Market snapshot, summary and alert digest, one line of text per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values as V
from ..functions.scalars import capitalise, fixed, money, signed_pct
from ..operators.windows import latest_per


def latest_prices(returns: DataFrame) -> DataFrame:
    """Each asset's newest price and return; stocks may lag behind crypto."""
    return latest_per(
        returns.select("symbol", "asset_type", "price", "daily_return_pct", "date"), by="symbol", order="date"
    )


def alert_rollup(alerts: DataFrame, as_of: Column) -> DataFrame:
    """Alerts of one day, counted: a row for each type and symbol.

    Whoever prints a type's list sorts and joins its rows.
    """
    today = alerts.filter(F.col("date") == as_of)
    return today.groupBy("alert_type", "symbol").agg(F.count(F.lit(1)).alias("alert_count"))


def pair_type_correlation(correlations: DataFrame) -> DataFrame:
    """Newest 30-row correlation of each pair, averaged by pair type."""
    known = correlations.filter(F.col("correlation_30d").isNotNull()).select(
        "symbol_a", "symbol_b", "pair_type", "correlation_30d", "date_key"
    )
    newest = latest_per(known, by=["symbol_a", "symbol_b"], order="date_key")
    return newest.groupBy("pair_type").agg(
        F.round(F.avg(F.col("correlation_30d").cast("decimal(10,4)")), 2).cast("double").alias("avg_correlation"),
        F.count(F.lit(1)).alias("pair_count"),
    )


def price_lines(latest: DataFrame, as_of: Column) -> DataFrame:
    """One formatted line per asset; assets behind ``as_of`` say so."""
    lag = F.when(
        F.col("date") != as_of, F.concat(F.lit(" [as of "), F.col("date").cast("string"), F.lit("]"))
    ).otherwise("")
    return latest.select(
        "asset_type",
        "symbol",
        F.concat(
            F.lit("  "), capitalise(F.col("symbol")), F.lit(": "), money(F.col("price")),
            F.lit(" ("), signed_pct(F.col("daily_return_pct")), F.lit(")"), lag,
        ).alias("line"),
    )


def _section(n: int, key: Column | str, line: Column) -> list[Column]:
    key = F.lit(key) if isinstance(key, str) else key
    return [F.lit(n).alias("section"), key.alias("item"), line.alias("line")]


def snapshot_lines(
    latest: DataFrame, alerts: DataFrame, correlations: DataFrame, as_of: Column
) -> DataFrame:
    """The snapshot text as (section, item, line), to be read in that order.

    Lines stay rows: the list of assets may be long, and whoever prints the
    text sorts by (section, item).
    """
    one = latest.sparkSession.range(1)
    prices = price_lines(latest, as_of)
    parts = [one.select(*_section(0, "", F.concat(F.lit("Market data for "), as_of.cast("string"), F.lit(":"))))]
    for n, kind in ((1, V.CRYPTO), (2, V.STOCK)):
        rows = prices.filter(F.col("asset_type") == kind)
        any_row = rows.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
        parts.append(any_row.select(*_section(n, "", F.lit(f"{kind.upper()}:"))))
        parts.append(rows.select(*_section(n, F.col("symbol"), F.col("line"))))

    counts = alerts.agg(F.sum("alert_count").alias("total"))
    title = F.when(F.col("total").isNull(), "ACTIVE ALERTS: none").otherwise(
        F.concat(F.lit("ACTIVE ALERTS ("), F.col("total").cast("string"), F.lit("):"))
    )
    parts.append(counts.select(*_section(3, "", title)))
    kinds = alerts.groupBy("alert_type").agg(F.sum("alert_count").alias("alert_count"))
    heading = F.concat(F.lit("  "), F.col("alert_type"), F.lit(" x"), F.col("alert_count").cast("string"), F.lit(":"))
    parts.append(kinds.select(*_section(3, F.col("alert_type"), heading)))
    shown = F.concat(F.lit("    "), capitalise(F.col("symbol")))
    parts.append(alerts.select(*_section(3, F.concat_ws(" ", "alert_type", "symbol"), shown)))

    any_pair = correlations.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    parts.append(
        any_pair.select(*_section(4, "", F.lit("30-DAY RETURN CORRELATION (latest per pair, averaged):")))
    )
    noun = F.when(F.col("pair_count") == 1, " pair)").otherwise(" pairs)")
    parts.append(
        correlations.select(
            *_section(
                4,
                F.col("pair_type"),
                F.concat(
                    F.lit("  "), F.col("pair_type"), F.lit(": "), fixed(F.col("avg_correlation"), 2),
                    F.lit(" ("), F.col("pair_count").cast("string"), noun,
                ),
            )
        )
    )
    return reduce(DataFrame.unionByName, parts)


def best_worst(latest: DataFrame) -> DataFrame:
    """First and last asset by falling return; assets without one are left out.

    Ties keep the order of asset type and symbol, so the first of the best and
    the last of the weakest are named.
    """
    known = latest.filter(F.col("daily_return_pct").isNotNull())
    rank = F.struct((-F.col("daily_return_pct")).alias("fall"), "asset_type", "symbol")
    return known.agg(
        F.min_by("symbol", rank).alias("best_symbol"),
        F.max("daily_return_pct").alias("best_pct"),
        F.max_by("symbol", rank).alias("worst_symbol"),
        F.min("daily_return_pct").alias("worst_pct"),
    )


def daily_summary(
    latest: DataFrame, alerts: DataFrame, correlations: DataFrame, as_of: Column
) -> DataFrame:
    """(summary_date, summary_text): the day in a few sentences, one row."""
    best = best_worst(latest)
    # three alert types and three pair types: a fixed few rows
    active = alerts.agg(
        F.sum("alert_count").alias("total"),
        F.array_join(F.array_sort(F.collect_set("alert_type")), ", ").alias("types"),
    )
    by_type = correlations.agg(
        F.max(F.when(F.col("pair_type") == "Crypto-Crypto", F.col("avg_correlation"))).alias("crypto"),
        F.max(F.when(F.col("pair_type") == "Crypto-Stock", F.col("avg_correlation"))).alias("mixed"),
    )
    # three one-row results side by side
    day = best.select("*", as_of.alias("summary_date")).withColumns(
        {
            "total": active.select("total").scalar(),
            "types": active.select("types").scalar(),
            "crypto": by_type.select("crypto").scalar(),
            "mixed": by_type.select("mixed").scalar(),
        }
    )
    performers = F.concat(
        F.lit("Best performer: "), capitalise(F.col("best_symbol")), F.lit(" at "), signed_pct(F.col("best_pct")),
        F.lit(". Weakest: "), capitalise(F.col("worst_symbol")), F.lit(" at "), signed_pct(F.col("worst_pct")),
        F.lit("."),
    )
    alerts_text = F.when(F.col("total").isNull(), "No alerts active.").otherwise(
        F.concat(F.col("total").cast("string"), F.lit(" alert(s) active ("), F.col("types"), F.lit(")."))
    )
    mixed = F.when(
        F.col("mixed").isNotNull(), F.concat(F.lit(", crypto-to-stock: "), fixed(F.col("mixed"), 2))
    ).otherwise("")
    related = F.concat(
        F.lit("Average 30-day crypto correlation: "), fixed(F.col("crypto"), 2), mixed, F.lit(".")
    )
    opening = F.concat(F.lit("Market summary for "), F.col("summary_date").cast("string"), F.lit("."))
    # concat_ws leaves out the parts that are NULL
    return day.select(
        "summary_date", F.concat_ws(" ", opening, performers, alerts_text, related).alias("summary_text")
    )


def alert_digest(new_alerts: DataFrame) -> DataFrame:
    """(kind, alert_date, symbol, alert_type, line): a subject, then one line per alert."""
    subject = new_alerts.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("subject").alias("kind"),
        F.lit(None).cast("date").alias("alert_date"),
        F.lit(None).cast("string").alias("symbol"),
        F.lit(None).cast("string").alias("alert_type"),
        F.concat(F.col("n").cast("string"), F.lit(" new market alert(s)")).alias("line"),
    )
    lines = new_alerts.select(
        F.lit("line").alias("kind"),
        F.col("alert_date"),
        F.col("asset_id").alias("symbol"),
        "alert_type",
        F.concat(F.lit("- "), capitalise(F.col("asset_id")), F.lit(": "), F.col("alert_message")).alias("line"),
    )
    return subject.unionByName(lines)


def alert_log_rows(alerts: DataFrame) -> DataFrame:
    """Alerts in the shape of the notification log."""
    return alerts.select(
        F.col("symbol").alias("asset_id"), F.col("date").alias("alert_date"), "alert_type", "alert_message"
    )


ALERT_KEY = ["asset_id", "alert_date", "alert_type"]


def unsent_alerts(alerts: DataFrame, log: DataFrame) -> DataFrame:
    """Alerts whose key is not in the log yet."""
    return alert_log_rows(alerts).join(log.select(*ALERT_KEY), ALERT_KEY, "left_anti")
