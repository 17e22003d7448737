"""Readers and writers of records as JSON files: grades, transcripts, lines of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_json(spark: SparkSession, root: str, schema: str | T.StructType, whole_files: bool = False, strict: bool = False) -> DataFrame:
    """JSON records below a folder, a line or a whole file each, with the path of their file.

    Lines end at line feeds only. Folders _raw and _obsolete are no data. A broken record stops
    the job if ``strict``, else it is a row of nulls with its text in _corrupt_record.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    kind = schema if strict else T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.schema(kind).option("recursiveFileLookup", True).option("multiLine", whole_files).option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    rows = (reader if whole_files else reader.option("lineSep", "\n")).json(root).withColumn("path", F.col("_metadata.file_path"))
    return rows.where(~F.col("path").rlike("/(_raw|_obsolete)/"))


def read_grades(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    """Grades with whether they are excluded: those with validation errors; a record without a grade is none."""
    rows = read_json(spark, root, schema).where("_corrupt_record is null and grade is not null").drop("_corrupt_record")
    return rows.withColumn("excluded", F.coalesce(F.size("validation_errors") > 0, F.lit(False)))


def read_transcripts(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    """Transcripts that can be read and have a person and a text."""
    return read_json(spark, root, schema).where("_corrupt_record is null and slug is not null and text is not null").drop("_corrupt_record")


def write_lines(rows: DataFrame, by: str, order: list[str], path: str) -> None:
    """One JSON line for each row, keys in order; a group's rows stand together in their order."""
    names = sorted(rows.columns)
    line = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    rows.repartition(by).sortWithinPartitions(by, *order).select(line.alias("value")).write.text(path, lineSep="\n")


def corpus_digest(rows: DataFrame, line: Column) -> DataFrame:
    """(rows, digest): SHA-256 over the lines of all rows whatever their order, by the first digits of their digests, so that no group holds all of them.

    A null line counts as a row only; without any line the digest is null.
    """
    each = rows.select(F.sha2(line, 256).alias("h"))
    parts = each.groupBy(F.substring("h", 1, 2).alias("b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("d"), F.count("*").alias("n"))
    whole = parts.agg(F.sum("n").alias("rows"), F.array_sort(F.collect_list(F.concat("b", F.lit(" "), "d"))).alias("p"))  # 256 parts at most
    return whole.select("rows", F.when(F.size("p") > 0, F.sha2(F.array_join("p", "\n"), 256)).alias("digest"))
