"""JSON messages to typed columns (F1), and the missing-field policies (F2).

A message must hold exactly one JSON object. Spark's parser stops at the end
of the first object and reads an empty text as "no record", so the text is
parsed as the first of two elements of a list, ``{"list":[<text>,{"mark":true}]}``.
Left-over text, several objects and empty text are then malformed, or the list has
not the text and the mark as its two elements. List and mark have names made new
for each plan, so that no text can close the list and open it again.

``inline`` puts the parse behind a Generate node. Later filters on parsed
fields stay above it, so each message is parsed once however many columns and
checks use the result.
"""

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from tallystream.functions.picks import trailing_id
from tallystream.schemas import PICK_RECORD

_ONE = "__one"
_BAD = "__bad"


def enclosed(text: Column, mark_value: str) -> tuple[Column, str, str]:
    """The text as first element of a list with an end mark; names of list and mark."""
    names, mark = f"l{uuid.uuid4().hex}", f"m{uuid.uuid4().hex}"
    end = ',{"%s":%s}]}' % (mark, mark_value)
    return F.concat(F.lit('{"%s":[' % names), text, F.lit(end)), names, mark


def _parse(df: DataFrame, schema: StructType, value: str, mode: str) -> tuple[DataFrame, Column]:
    """Append ``__one`` (list of record and mark) and, if permissive, ``__bad``.

    The second value is true where the text held one object.
    """
    text, names, mark = enclosed(F.col(value), "true")
    element = StructType([*schema.fields, StructField(mark, BooleanType())])
    root, columns = StructType().add(names, ArrayType(element)), [_ONE]
    options = {"mode": mode, "allowSingleQuotes": "false"}
    if mode == "PERMISSIVE":
        root = root.add(_BAD, StringType())
        columns.append(_BAD)
        options["columnNameOfCorruptRecord"] = _BAD
    parsed = F.inline(F.array(F.from_json(text, root, options))).alias(*columns)
    last = F.get(_ONE, F.lit(1))
    single = (F.size(_ONE) == 2) & _record().isNotNull() & _record()[mark].isNull() & last[mark]
    return df.select("*", parsed), F.coalesce(single, F.lit(False))


def _record() -> Column:
    return F.get(_ONE, F.lit(0))


def _missing(value: str, required: Iterable[str]) -> Column:
    """True if a required key is absent.

    A field with a value proves its key, so the keys are listed (a second
    look at the text) only for records that have a null in a required field.
    """
    required = list(required)
    any_null = F.lit(False)
    for name in required:
        any_null = any_null | _record()[name].isNull()
    keys = F.json_object_keys(value)
    absent = F.size(F.array_except(F.array(*map(F.lit, required)), keys)) > 0
    return F.when(any_null, F.coalesce(absent, F.lit(True))).otherwise(F.lit(False))


def _require(df: DataFrame, ok: Column, message: str, value: str) -> DataFrame:
    """Fail the query on a row that is not ``ok``. A filter cannot be pruned away."""
    shown = F.coalesce(F.substring(value, 1, 200), F.lit("null"))
    fail = F.raise_error(F.concat(F.lit(message + ": "), shown)).cast("boolean")
    return df.where(F.when(ok, F.lit(True)).otherwise(fail))


def _checked(
    parsed: DataFrame,
    single: Column,
    schema: StructType,
    value: str,
    required: Iterable[str],
    keep: Iterable[str],
) -> DataFrame:
    parsed = _require(parsed, single, "not one JSON object", value)
    if required:
        parsed = _require(parsed, ~_missing(value, required), "missing field", value)
    return parsed.select(*keep, *(_record()[n].alias(n) for n in schema.fieldNames()))


def parse_messages(
    df: DataFrame,
    schema: StructType,
    strict: bool = False,
    value: str = "value",
    required: Iterable[str] = (),
    keep: Iterable[str] = (),
) -> DataFrame:
    """typed columns of a JSON text column, matched by name.

    Malformed text, a wrong type or a number out of range fail the query.
    A missing field is null when lenient; with ``strict`` (or for the names in
    ``required``) it fails. A field given as ``null`` passes. Fields that are
    not declared are ignored. Null texts carry no row. ``keep`` names columns
    of ``df`` to carry along.
    """
    parsed, single = _parse(df, schema, value, "FAILFAST")
    parsed = parsed.where(F.col(_ONE).isNotNull())
    names = schema.fieldNames() if strict else list(required)
    return _checked(parsed, single, schema, value, names, keep)


def parse_picks(df: DataFrame, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """Record profile of F2: the five keys of a pick, and the user id.

    The keys must exist, and a null text fails. Fields may be null, except the
    user key, and the stake of a pick that counts (checked where it is added
    up).
    """
    parsed, single = _parse(df, PICK_RECORD, value, "FAILFAST")
    picks = _checked(parsed, single, PICK_RECORD, value, PICK_RECORD.fieldNames(), keep)
    return picks.withColumn("user_id", trailing_id(F.col("user_fkey")))


def quarantine(
    df: DataFrame,
    schema: StructType,
    value: str = "value",
    required: Iterable[str] = (),
    corrupt: str = "corrupt_record",
    reason: str | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Quarantine profile of F2: no message fails the query.

    Good messages have typed fields and a null ``corrupt`` column. Bad ones
    have null fields and their text in ``corrupt``, so that a ``where`` on that
    column splits the stream. ``reason`` names a column for why: ``malformed``
    or ``missing field``. Null texts carry no row.
    """
    parsed, single = _parse(df, schema, value, "PERMISSIVE")
    parsed = parsed.where(F.col(_ONE).isNotNull() | F.col(_BAD).isNotNull())
    required = list(required)
    why = F.when(F.col(_BAD).isNotNull() | ~single, "malformed")
    if required:
        why = why.when(_missing(value, required), "missing field")
    parsed = parsed.withColumn("__why", why)
    good = F.col("__why").isNull()
    return parsed.select(
        *keep,
        *(F.when(good, _record()[n]).alias(n) for n in schema.fieldNames()),
        F.when(~good, F.col(value)).alias(corrupt),
        *([] if reason is None else [F.col("__why").alias(reason)]),
    )
