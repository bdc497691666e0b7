"""Field access on schema-less JSON text.

Messages are parsed **once** per row: ``json_fields`` adds every wanted field with one
``json_tuple`` generator (a plan node, so later filters on the fields cannot be pushed below it
and re-parse the text), and ``json_keys`` lists the keys of a JSON object (null for anything
that is not an object), which tells a present-but-null field from an absent one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationdw.functions.numeric import col_of


def json_keys(text: Column | str) -> Column:
    """Keys of the outermost JSON object; null for arrays, scalars, blank or broken text."""
    return F.json_object_keys(col_of(text))


def json_fields(df: DataFrame, text: Column | str, names: Sequence[str], prefix: str
                ) -> tuple[DataFrame, dict[str, Column]]:
    """Add one text column per field name, parsing the JSON once.

    Returns the frame and a map from field name to its column. Columns are numbered
    (``<prefix>0`` ...) because field names may differ only by case (JSON is case-sensitive,
    Spark column resolution is not).
    """
    names = list(dict.fromkeys(names))
    outs = [f"{prefix}{i}" for i in range(len(names))]
    out = df.select("*", F.json_tuple(col_of(text), *names).alias(*outs))
    return out, {n: F.col(o) for n, o in zip(names, outs)}


def settled(df: DataFrame, cols: dict[str, Column], prefix: str
            ) -> tuple[DataFrame, dict[str, Column]]:
    """Add the columns through a generator of one row. Their expressions are then evaluated once
    a row, and not again in every filter and projection that uses them."""
    if not cols:
        return df, {}
    outs = {n: f"{prefix}{i}" for i, n in enumerate(cols)}
    row = F.struct(*[c.alias(outs[n]) for n, c in cols.items()])
    return df.select("*", F.inline(F.array(row))), {n: F.col(o) for n, o in outs.items()}


def first_present(keys: Column, values: dict[str, Column], names: Sequence[str]) -> Column:
    """Value of the first name present among ``keys``, even when that value is null."""
    expr = None
    for name in names:
        has = F.coalesce(F.array_contains(keys, F.lit(name)), F.lit(False))
        expr = F.when(has, values[name]) if expr is None else expr.when(has, values[name])
    return expr


def json_types(text: Column | str, names: Sequence[str]) -> dict[str, Column]:
    """The JSON type of each field of an object (STRING, BOOLEAN, BIGINT, ...; null if absent)."""
    parsed = F.try_parse_json(col_of(text))
    return {n: F.schema_of_variant(F.try_variant_get(parsed, f"$.{n}", "variant"))
            for n in dict.fromkeys(names)}


def truthy(v: Column, kind: Column) -> Column:
    """Python truthiness of a JSON value from its text and JSON type: null, "", number 0, false,
    [] and {} are falsy; any other text, "0" and "false" included, is not."""
    number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    falsy = (v.isNull() | (v == F.lit("")) | ((kind == "BOOLEAN") & (v == F.lit("false")))
             | (number & (v.try_cast("double") == F.lit(0.0)))
             | ((kind != "STRING") & v.isin("[]", "{}")))
    return ~F.coalesce(falsy, F.lit(False))


def pick_or(primary: Column, fallback: Column, kind: Column) -> Column:
    """``primary or fallback`` with Python semantics; ``kind`` is the JSON type of ``primary``."""
    return F.when(truthy(primary, kind), primary).otherwise(fallback)
