"""JSON message decode and encode as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverwatch import schema as S

# A NaN token in a string field decodes to this text (quotes included).
NAN_TEXT = '"NaN"'


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message_text(value: str | Column = "value") -> Column:
    """Kafka values are bytes; files give strings. Both end up as text."""
    return _c(value).cast("string")


def parse(
    text: Column,
    schema: T.StructType = S.READING,
    corrupt_column: str | None = None,
    options: dict[str, str] | None = None,
) -> Column:
    """``from_json`` in PERMISSIVE mode: bad JSON gives a struct of NULLs,
    a wrong-typed field gives NULL for that field only, extra keys are
    ignored. With ``corrupt_column`` the struct gains that string field,
    filled with the raw text whenever anything failed to parse."""
    if corrupt_column:
        schema = T.StructType(
            schema.fields + [T.StructField(corrupt_column, T.StringType(), True)]
        )
        return F.from_json(
            text, schema, {"columnNameOfCorruptRecord": corrupt_column, **(options or {})}
        )
    return F.from_json(text, schema, options or {})


STRICT = {"allowSingleQuotes": "false"}


def is_one_json_value(text: Column) -> Column:
    """Whether the whole text is one JSON value, with nothing after it.

    Spark's JSON reader stops after the first value. Here the text is the first
    of two array elements, the other being its MD5, which it cannot hold itself;
    so anything else changes the number of elements or breaks the array: trailing
    text, a second value, an early closing bracket."""
    end = F.md5(text)
    pair = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), end, F.lit('"]')),
                       "array<string>", STRICT)
    return F.coalesce((F.size(pair) == 2) & (F.get(pair, F.lit(1)) == end), F.lit(False))


VALUES, END = "__values", "__end"
_JSON_START = "^[ \\t\\n\\r]*[\\[{\"0-9tfnNI-]"


def parse_whole(text: Column, schema: T.StructType = S.READING) -> Column:
    """One parse of ``text`` that also tells whether it is one JSON value as a whole.

    The text is read as the first of two array elements; the second carries a hash of the
    text, which the text cannot hold itself, so trailing text or a second value
    leave something else behind the first. Gives a struct of that array and, where
    anything failed, the text; see ``whole_value`` and ``is_whole``."""
    element = T.StructType([*schema.fields, T.StructField(END, T.StringType())])
    both = T.StructType([T.StructField(VALUES, T.ArrayType(element)),
                         T.StructField(S.CORRUPT_RECORD, T.StringType())])
    framed = F.concat(F.lit(f'{{"{VALUES}":['), text, F.lit(f',{{"{END}":"'), F.hex(F.xxhash64(text)),
                      F.lit('"}]}'))
    return F.from_json(framed, both, {"columnNameOfCorruptRecord": S.CORRUPT_RECORD, **STRICT})


def whole_value(parsed: Column) -> Column:
    """The reading of ``parse_whole``; NULL where the text is no JSON object."""
    return F.get(parsed[VALUES], F.lit(0))


def is_whole(parsed: Column, text: Column) -> Column:
    """Whether the text that ``parse_whole`` read is one JSON value. A JSON value that is
    no object breaks the array of readings, so only such texts are parsed once more."""
    values = parsed[VALUES]
    ended = (F.size(values) == 2) & (F.get(values, F.lit(1))[END] == F.hex(F.xxhash64(text)))
    again = F.when(text.rlike(_JSON_START), is_one_json_value(text)).otherwise(F.lit(False))
    return F.when(values.isNull(), again).otherwise(F.coalesce(ended, F.lit(False)))


def clean_field(field: Column, dtype: T.DataType, keep_nan: bool) -> Column:
    """Map NaN (double) and the ``"NaN"`` text (string) to NULL unless
    ``keep_nan``; a missing value then behaves as missing, not as +inf."""
    if keep_nan:
        return field
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(field, F.lit(None).cast(dtype))
    if isinstance(dtype, T.StringType):
        return F.when(field == F.lit(NAN_TEXT), F.lit(None)).otherwise(field)
    return field


def encode(columns: list[str] | None = None) -> Column:
    """Row -> JSON text (``to_json``): NULL fields are left out, NaN is
    written as the string "NaN", which ``parse`` reads back as NaN."""
    cols = columns or S.READING_COLUMNS
    return F.to_json(F.struct(*[F.col(c) for c in cols]))
