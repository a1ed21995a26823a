"""Alert rows and message payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ALERT_FIELD_TITLES, ALERT_TEXT
from ..functions.scoring import alert_color, alert_label

ALERT_COLS = ["car_model", "accident", "start_batch_time", "news_acc_count", "comm_acc_count",
              "issue_score", "dashboard_url"]


def alertable(state: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The seven alert columns of rows flagged is_alert (F1), and ``keep``."""
    return state.filter(F.col("is_alert")).select(*ALERT_COLS, *keep)


def iso_time(c) -> Column:
    """ISO-8601 text of a timestamp, with microseconds only when non-zero."""
    c = F.col(c) if isinstance(c, str) else c
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros))


def render_alert(alerts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One message payload (JSON text) per alert row."""
    level, color = alert_label("issue_score"), alert_color("issue_score")
    subject = F.concat(F.col("car_model"), F.lit(" "), F.col("accident"))
    text = F.format_string(ALERT_TEXT.format(car_model="%1$s", accident="%2$s", level="%3$s"),
                           F.col("car_model"), F.col("accident"), level)
    values = [level, subject, iso_time("start_batch_time"), F.col("dashboard_url")]
    fields = F.array(*[F.struct(F.lit(t).alias("title"), v.alias("value"),
                                F.lit(False).alias("short"))
                       for t, v in zip(ALERT_FIELD_TITLES, values)])
    payload = F.struct(text.alias("text"),
                       F.array(F.struct(color.alias("color"), fields.alias("fields")))
                       .alias("attachments"))
    return alerts.select("car_model", "accident", level.alias("level"), color.alias("color"),
                         F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"), *keep)
