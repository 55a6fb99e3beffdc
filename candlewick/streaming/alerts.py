"""Exactly-once alert logging from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators.writes import append_to_log
from ..plans.reports import ALERT_KEY
from ..session import configure


def stream_alert_log(
    alerts: DataFrame, *, sink: str, order_by: str, checkpoint: str
) -> StreamingQuery:
    """Append each alert key once, however often it is raised or retried.

    ``alerts`` has the log's columns plus ``order_by``; of several alerts
    with one key the first is logged.
    """
    configure(alerts.sparkSession)

    def write(batch: DataFrame, _: int) -> None:
        append_to_log(
            batch.sparkSession, sink, batch, schema=S.ALERT_LOG, month_of="alert_date",
            keys=ALERT_KEY, order_by=order_by,
        )

    return (
        alerts.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
