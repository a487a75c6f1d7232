"""CSV in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

from wardframe.sources.schemas import NOTE_LABELS, struct

_SPLIT = ["_file", "_block"]
_RECORD = ["_file", "_from_block", "_from_line"]


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    gz: bool = False,
    partitions: int | None = None,
    multi_line: bool = False,
    whole_files: bool = False,
) -> DataFrame:
    """Read a CSV file, or a folder of them, under a declared schema; a malformed row or another header aborts.

    Columns come out in lower case. A plain file is read in splits, with ``multi_line`` too, where quoted
    fields may span lines (see ``split_records``). A compressed file, or any with ``whole_files``, is one task then,
    so give a folder of files, or ``partitions`` to spread the rows before they are worked on.
    """
    schema = struct(schema) if isinstance(schema, str) else schema
    if multi_line and not gz and not whole_files:
        df = _parsed(split_records(spark, path), schema)
    else:
        # Header names are compared without regard to case, order counts.
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(f"{path}.gz" if gz else path)
        )
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.repartition(partitions) if partitions and partitions > 1 else df


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their split, and a number that grows along the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("_text"),
        _quotes(F.col("value")).alias("_quotes"),
    )


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """``_text, _first`` of every record of CSV files whose quoted fields may hold line breaks, read in splits.

    A line starts a record if an even number of quotes stands before it in its file; doubled quotes don't
    matter, as they count twice. So one pass counts the quotes of every split, running sums over a file's
    splits (a row each) say in which state a split begins, and the second pass finds the starts within
    each split and joins the lines of a record. Only a record that goes on in the next split meets its other part
    by a key of its own: the split in which it began. ``_first`` marks a file's first record.

    A quote inside a field that is not quoted has no place in such files; it would make records run on, which
    the parser then refuses. Blank records drop out, and in a file whose first line ends with a carriage return all ends of lines
    become plain ones, both as in Spark's own reader.
    """
    in_split = W.partitionBy(*_SPLIT).orderBy("_id")
    earlier = in_split.rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_quotes").over(earlier), F.lit(0))

    along = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    splits = (
        _lines(spark, path)
        .withColumn("_before", before)
        .groupBy(*_SPLIT)
        .agg(
            F.sum("_quotes").alias("_all"),
            F.bool_or(F.col("_before") % 2 == 1).alias("_has_odd"),
            F.min_by(F.col("_text").endswith("\r"), "_id").alias("_cr"),
        )
        .withColumn("_start", F.coalesce(F.sum("_all").over(along), F.lit(0)) % 2)
        .withColumn("_begins", (F.col("_start") == 0) | F.col("_has_odd"))
        .select(
            *_SPLIT,
            "_start",
            ((F.col("_start") + F.col("_all")) % 2 == 1).alias("_goes_on"),
            F.last(F.when(F.col("_begins"), F.col("_block")), ignorenulls=True).over(along).alias("_began"),
            F.first("_cr").over(W.partitionBy("_file").orderBy("_block")).alias("_crlf"),
        )
    )
    placed = (
        _lines(spark, path)
        .withColumns({"_line": F.row_number().over(in_split), "_before": before})
        .join(splits, _SPLIT)
        .withColumn("_starts", F.when((F.col("_before") + F.col("_start")) % 2 == 0, F.col("_line")))
    )
    upto = W.partitionBy(*_SPLIT).orderBy("_line").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = placed.withColumns(
        {
            "_own": F.max("_starts").over(upto),
            "_last": F.max("_starts").over(W.partitionBy(*_SPLIT)),
        }
    )
    # The last record of a split that goes on is number 0 of that split, also for its later parts.
    open_ = (F.col("_own") == F.col("_last")) & F.col("_goes_on")
    parts = (
        placed.withColumns(
            {
                "_from_block": F.when(F.col("_own").isNull(), F.col("_began")).otherwise(F.col("_block")),
                "_from_line": F.when(F.col("_own").isNull() | open_, F.lit(0)).otherwise(F.col("_own")),
            }
        )
        .groupBy(*_RECORD, "_block")
        .agg(
            F.array_sort(F.collect_list(F.struct("_line", "_text"))).alias("_lines"),
            F.min(F.struct("_block", "_line")).alias("_at"),
            F.any_value("_crlf").alias("_crlf"),
        )
    )
    whole = parts.groupBy(*_RECORD).agg(
        F.array_sort(F.collect_list(F.struct("_block", "_lines"))).alias("_parts"),
        F.min("_at").alias("_at"),
        F.any_value("_crlf").alias("_crlf"),
    )
    lines = F.flatten(F.transform("_parts", lambda p: p["_lines"]))
    text = F.array_join(F.transform(lines, lambda x: x["_text"]), "\n")
    plain = F.replace(F.regexp_replace(text, "\r$", ""), F.lit("\r\n"), F.lit("\n"))
    return whole.select(
        F.when(F.col("_crlf"), plain).otherwise(text).alias("_text"),
        ((F.col("_at._block") == 0) & (F.col("_at._line") == 1)).alias("_first"),
    ).where(F.trim("_text") != "")


def _parsed(records: DataFrame, schema: StructType) -> DataFrame:
    """The records' columns; the first record of a file must name them, in any case."""
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true"}
    names = ",".join(f"`{f.name}` string" for f in schema)
    wanted = F.array(*[F.lit(f.name.lower()) for f in schema])
    header = F.from_csv("_text", names, options)
    named = F.array(*[F.lower(header[f.name]) for f in schema])
    wrong = F.raise_error(F.concat(F.lit("CSV header does not name the columns of the schema: "), F.col("_text")))
    is_row = F.when(~F.col("_first"), F.lit(True)).when(named == wanted, F.lit(False)).otherwise(wrong.cast("boolean"))
    columns = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    row = F.from_csv("_text", columns, options)
    return records.where(is_row).select(row.alias("_row")).select("_row.*")


def read_note_labels(spark: SparkSession, path: str) -> DataFrame:
    """Note labels with their ISO timestamp parsed; a bad timestamp fails the job (ANSI mode)."""
    raw = read_table(spark, path, NOTE_LABELS)
    return raw.select(
        "subject_id", "hadm_id", F.to_timestamp_ntz("timestamp_str").alias("timestamp"), "label"
    )


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header, NULL as an empty field, one file per task unless asked for one."""
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    # Quotes are doubled and texts keep their blanks, so that `read_table` gives the rows back;
    # only an empty text reads as NULL.
    (
        writer.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .csv(path)
    )
