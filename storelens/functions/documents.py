"""JSON text columns: validity and typed fields from one parse per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions import convert

_END = "_end_of_text"
_STRICT = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def opened(df: DataFrame, text: Column, schema: T.StructType) -> DataFrame:
    """Add ``document``, the fields of ``schema``, and ``valid`` to every row.

    The parser stops after the first value, so the text is read as the first element of a list whose second one is a
    mark made from the text itself. The document is valid when the list ends with the mark and has nothing between. A
    field of another type than expected is NULL and the others stay. Only texts that are no object (lists, scalars,
    broken ones) are looked at again, for their validity. The explode of a one-element array keeps later filters on
    ``document`` from repeating the parse below it.
    """
    mark = F.md5(text.cast("binary"))
    wrapped = F.concat(F.lit("["), text, F.lit(f',{{"{_END}":"'), mark, F.lit('"}]'))
    full = T.ArrayType(T.StructType([*schema.fields, T.StructField(_END, T.StringType())]))
    parsed = df.select("*", F.explode(F.array(F.from_json(wrapped, full, _STRICT))).alias("parsed_"))
    items = F.col("parsed_")
    closed = (F.size(items) == 2) & (F.get(items, F.lit(1))[_END] == mark)
    other = (
        F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 2)
        & (F.get_json_object(wrapped, f"$[1].{_END}") == mark)
    )
    found = (text != "") & F.when(F.coalesce(closed, F.lit(False)), F.lit(True)).otherwise(other)
    return parsed.withColumns({
        "valid": F.coalesce(found, F.lit(False)), "document": F.get(items, F.lit(0)),
    }).drop("parsed_")


def leaf_type(kind: str) -> T.DataType:
    """How a field is read from the document; all but flags and lists come as text."""
    if kind == "bool":
        return T.BooleanType()
    return T.ArrayType(T.StringType()) if kind == "strings" else T.StringType()


def document_schema(paths: dict[str, str]) -> T.StructType:
    """Nested schema that holds the given dotted paths with their kinds."""
    heads: dict[str, dict[str, str]] = {}
    for path, kind in paths.items():
        head, _, rest = path.partition(".")
        heads.setdefault(head, {})[rest] = kind
    return T.StructType([
        T.StructField(head, leaf_type(rests[""]) if "" in rests else document_schema(rests))
        for head, rests in heads.items()
    ])


def typed(value: Column, kind: str) -> Column:
    """Column of one kind from what was read for the field."""
    rules = {
        "lower": convert.lower_or_null,
        "json": convert.lower_or_null,
        "text": convert.blank_to_null,
        "double": convert.to_double,
        "uint16": convert.to_uint16,
        "date": convert.to_day,
        "timestamp": convert.to_moment,
        "bool": lambda v: F.coalesce(v, F.lit(False)),
        "strings": lambda v: F.coalesce(v, F.array().cast("array<string>")),
    }
    return rules[kind](value)
