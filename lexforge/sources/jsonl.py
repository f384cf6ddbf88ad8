"""JSON-lines and text sources and sinks; bad lines are classified, never fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): lines numbered from 1 within each file.

    Lines are numbered per file and block of the file: counts of the blocks before are added, so no file is ordered in
    one task.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.make_valid_utf8("value").alias("line"))
    inside = Window.partitionBy("file", "block").orderBy("id")
    sizes = lines.groupBy("file", "block").count()
    shift = F.coalesce(F.sum("count").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("file", "block", shift.alias("shift"))
    return lines.withColumn("n", F.row_number().over(inside)).join(starts, ["file", "block"]).select("file", (F.col("shift") + F.col("n")).alias("line_no"), "line")


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines of the files, for progress and shares, without parsing any."""
    return spark.read.text(path).count()


def parse(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """lines with value (VARIANT, null unless an object) and status: blank, bad_json, not_an_object or ok."""
    v = F.try_parse_json(F.col(line_col))
    status = F.when(T.strip(F.col(line_col)) == "", "blank").when(v.isNull(), "bad_json").when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "not_an_object").otherwise("ok")
    return lines.withColumn("status", status).withColumn("value", F.when(F.col("status") == "ok", v))


def text_field(name: str, value: str = "value") -> Column:
    """A text field of a parsed object; empty if it is missing or no string."""
    c = F.try_variant_get(F.col(value), f"$['{name}']", "string")
    kind = F.schema_of_variant(F.try_variant_get(F.col(value), f"$['{name}']", "variant"))
    return F.when(kind == "STRING", c).otherwise("")


def id_field(name: str, line_no: str = "line_no", value: str = "value") -> Column:
    """An id as text; a missing, empty, zero or false one becomes line<number>."""
    c = F.try_variant_get(F.col(value), f"$['{name}']", "string")
    return F.when(c.isNull() | c.isin("", "0", "0.0", "false"), F.concat(F.lit("line"), F.col(line_no))).otherwise(c)


def read_corpus(spark: SparkSession, path: str, text_name: str = "passage", id_name: str = "id", fill_name: bool = False) -> DataFrame:
    """(file, line_no, status, id, link, name, passage, meta): documents and the lines that are none.

    meta holds every field but the text, as JSON text.
    """
    rows = parse(read_lines(spark, path))
    name = text_field("name")
    if fill_name:
        name = F.when(name == "", T.name_from_link(text_field("link"))).otherwise(name)
    fields = F.from_json(F.to_json("value"), "map<string, string>")
    meta = F.to_json(F.map_filter(fields, lambda k, _: k != text_name))
    rows = rows.withColumn("passage", text_field(text_name)).withColumn("status", F.when((F.col("status") == "ok") & (T.strip(F.col("passage")) == ""), "empty_text").otherwise(F.col("status")))
    return rows.select("file", "line_no", "status", id_field(id_name).alias("id"), text_field("link").alias("link"), name.alias("name"), "passage", meta.alias("meta"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A whole JSON file: one object or a list of them. Lines files (.jsonl) are read strictly."""
    return spark.read.option("mode", "FAILFAST").json(path) if path.endswith(".jsonl") else spark.read.option("multiLine", True).json(path)


def read_plain_text(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one document named after its path."""
    return spark.read.text(path, wholetext=True).select(F.lit(None).cast("string").alias("id"), F.col("_metadata.file_path").alias("name"), F.col("value").alias("passage"))


def read_ids(spark: SparkSession, path: str | None = None, ids: str | None = None) -> DataFrame:
    """(id): from a comma list, a file of ids, or the slow documents of an earlier report."""
    if ids is not None:
        rows = spark.createDataFrame([(x.strip(),) for x in ids.split(",") if x.strip()], "id string")
    elif path.endswith(".json"):
        report = spark.read.text(path, wholetext=True).select(F.from_json("value", "slow_documents array<struct<id: string>>").alias("r"))
        rows = report.select(F.explode("r.slow_documents.id").alias("id"))
    else:
        rows = spark.read.text(path).select(T.strip(F.col("value")).alias("id")).where("id <> ''")
    return rows.distinct()


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Only the documents in a list of ids."""
    return docs.join(ids.select(F.col("id").alias("_wanted")), docs[id_col].cast("string") == F.col("_wanted"), "left_semi")


def write_jsonl(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Objects with their nulls written out."""
    w = df.write.option("ignoreNullFields", False).mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row as an indented JSON document."""
    report.select(F.to_json(F.struct(*report.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)
