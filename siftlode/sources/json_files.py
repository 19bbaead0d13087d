"""JSON and CSV at the edges: snapshot folders, arrays, missing files, and the export of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINK = "array<struct<text: string, href: string>>"
# Columns of a snapshot file.
SNAPSHOT = (
    "sourceId string, url string, fetchedAt timestamp, statusCode int, contentType string, rawHash string, textHash string, title string, visibleText string, "
    f"extractedLinks {LINK}, extractedEmails array<string>, fetchModeUsed string, error string"
)
# Columns of the export, in order.
EXPORT = (
    "id", "sourceId", "institutionName", "department", "roleType", "canton", "city", "availabilityStatus", "availableFrom", "fullyBookedUntil", "durationMinWeeks", "durationMaxWeeks",
    "applicationMethod", "applicationUrl", "contactEmail", "confidence", "reviewStatus", "sourceUrl", "lastChecked",
)
# Numbers of a crawl report.
REPORT = ("sourceCount", "urlCount", "successCount", "failureCount", "skippedCount", "duplicateUrlCount")


def array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of files that each hold one object or an array of them. A missing path raises."""
    return spark.read.schema(schema).json(path, multiLine=True)


def array_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same, empty where nothing is at the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return array(spark, path, schema) if there else spark.createDataFrame([], schema)


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot files of a folder with ``file``, by whose order the first of equal records is the one that counts."""
    read = spark.read.schema(SNAPSHOT).option("pathGlobFilter", "*.snapshot.json").json(folder, multiLine=True)
    return read.select("*", F.col("_metadata.file_name").alias("file"))


def failed() -> Column:
    """A snapshot with an error or a status of 400 and more."""
    return F.coalesce((F.col("error") != "") | (F.col("statusCode") >= 400), F.col("statusCode") >= 400, F.col("error") != "", F.lit(False))


def summary(read: DataFrame) -> DataFrame:
    """What changes keep of a snapshot."""
    return read.select("sourceId", "url", "statusCode", "rawHash", "textHash", "error")


def crawl_report(spark: SparkSession, path: str) -> DataFrame:
    """The one row of a crawl report; a number that is missing or negative raises when it is read."""
    row = spark.read.schema(", ".join(f"{c} double" for c in REPORT)).json(path, multiLine=True)
    checked = lambda c: F.when(F.coalesce(F.col(c) >= 0, F.lit(False)), F.col(c)).otherwise(F.raise_error(f"{c} must be a number of 0 or more").cast("double"))
    return row.select(*(checked(c).cast("long").alias(c) for c in REPORT))


def csv_cell(c: Column, is_array: bool = False) -> Column:
    """Null is nothing; all else stands in quotes, arrays joined."""
    text = F.array_join(c, "; ") if is_array else c.cast("string")
    return F.when(c.isNull(), "").otherwise(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')))


def csv_lines(records: DataFrame, columns=EXPORT) -> DataFrame:
    """``line``, the export's line of each record; its first line is ``csv_header``."""
    arrays = {f.name for f in records.schema.fields if f.dataType.typeName() == "array"}
    return records.select(F.concat_ws(",", *(csv_cell(F.col(c), c in arrays) for c in columns)).alias("line"))


def csv_header(columns=EXPORT) -> str:
    return ",".join(columns)
