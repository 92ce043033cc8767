"""JSON topics as named tables."""

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tallystream.functions.messages import parse_messages
from tallystream.operators.windows import with_proctime


def json_table(
    messages: DataFrame,
    schema: StructType,
    name: str | None = None,
    message_schema: StructType | None = None,
    strict: bool = False,
    proctime: bool = False,
) -> DataFrame:
    """A typed table over messages, batch or stream.

    ``schema`` is the table, in its column order. ``message_schema`` is the
    declared format of the message if its order differs; columns are matched by
    name (S4). ``strict`` fails on missing fields. ``proctime`` adds the
    processing-time column. With ``name`` the table is registered, and
    ``spark.table(name)`` or SQL reads it (S8).
    """
    parsed = parse_messages(messages, message_schema or schema, strict=strict)
    table = parsed.select(*schema.fieldNames())
    if proctime:
        table = with_proctime(table)
    if name is not None:
        table.createOrReplaceTempView(name)
    return table
