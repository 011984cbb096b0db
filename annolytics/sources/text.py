"""Delimited detection files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_detection_text(spark: SparkSession, path: str, n_columns: int, time_col: int, id_col: int, delimiter: str = ",", remove_negative_ids: bool = False, valid: Mapping[int, Sequence[str]] | None = None, crowd: Mapping[int, Sequence[str]] | None = None, convert: Mapping[int, Mapping[str, str]] | None = None) -> DataFrame:
    """Rows of delimited files as strings c0, c1, ... with time (long), id (long) and is_crowd.

    A row of more or fewer fields than n_columns is an error, but for an empty last field,
    which is stripped. valid: for a column the values that rows may have, in lower case; rows
    of others go. crowd: rows whose columns all have one of the values are crowds. convert:
    for a column the value that replaces each one; one that is not there is an error."""
    lines = spark.read.text(path)
    value = F.col("value")
    fields = F.split(F.trim(value), f"[{delimiter}]")
    fields = F.when((F.size(fields) == n_columns + 1) & (F.element_at(fields, -1) == ""), F.slice(fields, 1, n_columns)).otherwise(fields)
    ok = F.assert_true(F.size("fields") == n_columns, F.concat(F.lit("a row has not its fields: "), value))
    rows = lines.filter(F.trim(value) != "").withColumn("fields", fields).withColumn("fields", F.when(ok.isNull(), F.col("fields")))
    rows = rows.select(*(F.trim(F.col("fields")[i]).alias(f"c{i}") for i in range(n_columns)))
    rows = rows.withColumns({"time": F.col(f"c{time_col}").cast("double").cast("long"), "id": F.col(f"c{id_col}").cast("double").cast("long")})
    is_crowd = F.lit(False)
    if crowd:
        is_crowd = F.lit(True)
        for i, values in crowd.items():
            is_crowd = is_crowd & F.lower(f"c{i}").isin([v.lower() for v in values])
    rows = rows.withColumn("is_crowd", is_crowd)
    for i, values in (valid or {}).items():
        rows = rows.filter(F.lower(f"c{i}").isin([v.lower() for v in values]))
    if remove_negative_ids:
        rows = rows.filter("id >= 0")
    for i, table in (convert or {}).items():
        known = F.create_map(*(F.lit(x) for pair in table.items() for x in (pair[0].lower(), pair[1])))
        found = F.try_element_at(known, F.lower(f"c{i}"))
        missing = F.assert_true(found.isNotNull(), F.concat(F.lit("no value for "), F.col(f"c{i}")))
        rows = rows.withColumn(f"c{i}", F.when(missing.isNull(), found))
    return rows
