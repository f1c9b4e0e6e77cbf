"""JSON payload -> rows: parallel arrays, record arrays, wide -> long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType


def _parallel_schema(root: str, fields: Mapping[str, tuple[str, DataType]]) -> StructType:
    inner = StructType([StructField(src, ArrayType(t), True) for src, (_, t) in fields.items()])
    return StructType([StructField(root, inner, True)]) if root else inner


def with_parsed(df: DataFrame, keep: Sequence[str], parsed: Column, name: str) -> DataFrame:
    """``keep`` columns plus ``parsed`` AS ``name``, evaluated once per row.

    Catalyst pushes a later filter below the projection that defines a column
    by substituting the column's expression into the predicate, so filters on
    fields of a parsed payload would parse it again once per reference. A
    one-element ``inline`` makes the parsed value a generator output: filters
    on it stay above the generator and the payload is parsed exactly once.
    """
    return df.select(*keep, F.inline(F.array(F.struct(parsed.alias(name)))))


def parse_parallel_arrays(
    df: DataFrame, json_col: str, root: str, fields: Mapping[str, tuple[str, DataType]]
) -> DataFrame:
    """Parse the payload once into a struct of typed arrays (``_arrays``) and
    add ``_zip_ok``: all arrays present with one common length."""
    parsed = F.from_json(F.col(json_col), _parallel_schema(root, fields))
    df = with_parsed(df, df.columns, parsed[root] if root else parsed, "_arrays")
    arrays = F.col("_arrays")
    ok = arrays.isNotNull()
    for src in fields:
        ok = ok & arrays[src].isNotNull()
    sizes = [F.size(arrays[src]) for src in fields]
    for s in sizes[1:]:
        ok = ok & (s == sizes[0])
    return df.withColumn("_zip_ok", F.coalesce(ok, F.lit(False)))


def zip_arrays_unnest(
    df: DataFrame,
    json_col: str,
    root: str,
    fields: Mapping[str, tuple[str, DataType]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per array position of parallel JSON arrays ``root.{field}[]``.

    ``fields`` maps source field -> (output name, element type). Payloads whose
    arrays are missing or differ in length produce no rows here; get them with
    :func:`zip_arrays_rejects` (an unequal-length zip would silently pad).
    """
    parsed = parse_parallel_arrays(df, json_col, root, fields).where("_zip_ok")
    zipped = F.arrays_zip(*[F.col("_arrays")[src].alias(out) for src, (out, _) in fields.items()])
    return parsed.select(*keep, F.inline(zipped))


def zip_arrays_rejects(
    df: DataFrame,
    json_col: str,
    root: str,
    fields: Mapping[str, tuple[str, DataType]],
    keep: Sequence[str] = (),
    with_missing_root: bool = False,
) -> DataFrame:
    """Payloads that have a ``root`` object but unusable parallel arrays
    (``with_missing_root``: those without the object too)."""
    parsed = parse_parallel_arrays(df, json_col, root, fields).where(~F.col("_zip_ok"))
    if root and not with_missing_root:
        parsed = parsed.where(F.get_json_object(F.col(json_col), f"$.{root}").isNotNull())
    return parsed.select(*keep, json_col)


def record_array_unnest(
    df: DataFrame,
    json_col: str,
    path: str,
    record_schema: StructType,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per record of the JSON array at ``path`` (JSONPath, 0-based).

    ``record_schema`` types the records; absent fields become NULL, a missing
    or non-array path yields no rows.
    """
    records = F.from_json(F.get_json_object(F.col(json_col), path), ArrayType(record_schema))
    return df.select(*keep, F.inline(records))


def wide_to_long(
    df: DataFrame,
    id_cols: Sequence[str],
    columns: Mapping[str, str],
    name_col: str = "name",
    value_col: str = "value",
    value_type: str = "double",
    drop_nulls: bool = True,
) -> DataFrame:
    """Melt ``{label: column}`` into (name, value) rows in a single scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias(name_col), F.col(col).cast(value_type).alias(value_col))
            for label, col in columns.items()
        ]
    )
    out = df.select(*id_cols, F.inline(pairs))
    return out.where(F.col(value_col).isNotNull()) if drop_nulls else out
