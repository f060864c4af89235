"""Fields of log lines; a line that does not fit the pattern gives nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed line format: "date time LEVEL event_id=N user=N action=WORD message=REST".
LINE = (
    r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) ([A-Z]+)"
    r" event_id=(\d+) user=(\d+) action=(\w+) message=(.*)$"
)


def parse_line(line: Column) -> Column:
    """Struct of the fields, or null for a malformed line.

    The pattern only decides; the fields come from one split at spaces.
    """
    parts = F.split(line, " ", 7)

    def after_sign(i: int) -> Column:
        text = F.get(parts, F.lit(i))
        return F.substring(text, F.locate("=", text) + 1, F.length(text))

    fields = F.struct(
        F.concat_ws(" ", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))).alias("ts"),
        F.get(parts, F.lit(2)).alias("level"),
        after_sign(3).try_cast("bigint").alias("event_id"),
        after_sign(4).try_cast("bigint").alias("user_id"),
        after_sign(5).alias("action"),
        after_sign(6).alias("message"),
    )
    return F.when(line.rlike(LINE), fields)
