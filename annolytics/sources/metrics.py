"""Writers and readers of predictions and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.curation import write_form


def write_predictions(predictions: DataFrame, path: str, with_box: bool = True) -> None:
    """JSON lines of predictions, box and score rounded to 5 decimals."""
    out = write_form(predictions)
    if with_box:
        out = out.withColumn("bbox", F.array(*"xywh"))
    out.drop(*"xywh").write.json(path)


def pair_records(pair_metrics: DataFrame) -> DataFrame:
    """video_id, category_id, metric, value -> a row for each pair with a column a metric."""
    return pair_metrics.groupBy("video_id", "category_id").pivot("metric").agg(F.first("value"))


def write_metrics(metrics: DataFrame, pair_metrics: DataFrame, path: str) -> None:
    """metric, value as one row, and one row for each pair, as JSON below path."""
    metrics.groupBy().pivot("metric").agg(F.first("value")).write.json(f"{path}/dataset_results")
    pair_records(pair_metrics).write.json(f"{path}/video_np_results")


def significant(value: Column, digits: int = 5) -> Column:
    """A number in so many significant digits, as text."""
    magnitude = F.when(value == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(value)))).cast("int")
    scale = F.pow(F.lit(10.0), (digits - 1 - magnitude).cast("double"))
    rounded = F.round(value * scale) / scale
    return F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits + 3}f", rounded), r"0+$", ""), r"\.$", "")


def summary_row(fields: DataFrame, order: Sequence[str]) -> DataFrame:
    """alpha, then a column for each field -> one row of text: means over alpha times 100 in 5
    significant digits, the fields of `order` first, then the others by name."""
    names = [c for c in order if c in fields.columns] + sorted(c for c in fields.columns if c not in order and c != "alpha")
    return fields.agg(*(significant(100 * F.avg(c)).alias(c) for c in names))


def write_summary(fields: DataFrame, path: str, order: Sequence[str]) -> None:
    summary_row(fields, order).coalesce(1).write.csv(path, header=True, sep=" ")


def detailed_rows(by_sequence: DataFrame, fields: Sequence[str]) -> DataFrame:
    """seq, alpha and fields -> a row for each sequence, COMBINED last: field___alpha for each
    alpha and field___AUC, the mean."""
    rows = by_sequence.groupBy("seq").pivot("alpha").agg(*(F.first(f).alias(f) for f in fields))
    if len(fields) == 1:
        rows = rows.withColumnsRenamed({c: f"{c}_{fields[0]}" for c in rows.columns if c != "seq"})
    means = by_sequence.groupBy("seq").agg(*(F.avg(f).alias(f"{f}___AUC") for f in fields))
    renamed = {c: f"{c.split('_', 1)[1]}___{c.split('_', 1)[0]}" for c in rows.columns if c != "seq"}
    out = rows.withColumnsRenamed(renamed).join(means, "seq")
    return out.orderBy(F.col("seq") == "COMBINED", "seq")


def write_detailed(by_sequence: DataFrame, path: str, fields: Sequence[str]) -> None:
    detailed_rows(by_sequence, fields).write.csv(path, header=True)  # files in order, each with the header


def read_detailed(spark: SparkSession, path: str) -> DataFrame:
    """seq, field, alpha (text) and value of what write_detailed wrote; rows of another width
    are left out, and COMBINED is called COMBINED_SEQ."""
    header = spark.read.csv(path, header=True).columns
    schema = "seq string, " + ", ".join(f"`{c}` double" for c in header if c != "seq")
    rows = spark.read.schema(schema).csv(path, header=True, mode="DROPMALFORMED")
    long = rows.unpivot("seq", [c for c in header if c != "seq"], "column", "value")
    part = F.split("column", "___")
    return long.select(F.when(F.col("seq") == "COMBINED", "COMBINED_SEQ").otherwise(F.col("seq")).alias("seq"), part[0].alias("field"), part[1].alias("alpha"), "value")


def write_image_metrics(rows: DataFrame, path: str) -> None:
    """Rows of image_eval as JSON lines, before they are summed."""
    rows.write.json(path)


def read_last_metrics(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """path, key and value of the last line that is not empty of each JSON-lines log."""
    logs = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    last = F.element_at(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != ""), -1)
    parsed = logs.filter(F.trim("value") != "").withColumn("row", F.from_json(last, "map<string,string>"))
    rows = parsed.select("path", F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.try_element_at("row", F.lit(k)).cast("double").alias("value")) for k in keys))).alias("m"))
    return rows.select("path", "m.*").filter("value is not null")


def read_dataset_stats(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """dataset (the folder's name), key and value of the stats of each folder whose key ends in
    suffix. path: a pattern such as root/*/stats.json."""
    docs = spark.read.text(path, wholetext=True).withColumn("dataset", F.element_at(F.split(F.input_file_name(), "/"), -2))
    rows = docs.select("dataset", F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))
    return rows.filter(F.col("key").endswith(suffix)).select("dataset", "key", F.col("value").try_cast("double").alias("value"))
