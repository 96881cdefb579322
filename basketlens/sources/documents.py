"""Batch reads of nested documents."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas

log = logging.getLogger(__name__)


def scan_json(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Documents of a folder with an explicit schema; nothing is inferred, so the data is read once.

    A document that cannot be read keeps its text in the corrupt-record column and stops nothing.
    A missing folder is reported and gives no rows.
    """
    full = f"{schema}, {schemas.CORRUPT} string"
    try:
        return (
            spark.read.schema(full)
            .option("multiLine", multi_line)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", schemas.CORRUPT)
            .json(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no folder %s", path)
        return spark.createDataFrame([], full)


def readable(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)


def quarantined(documents: DataFrame) -> DataFrame:
    """Documents that could not be read, with their text. Write or collect it whole: Spark refuses to
    answer from the text column of a JSON file alone."""
    return documents.filter(F.col(schemas.CORRUPT).isNotNull())


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """A folder of documents, one a file, each as it is: path, document (a variant) and fault.

    Numbers, prices in quotes and fields nobody lists keep the text they have; `operators.flatten.json_to_raw` makes RAW
    rows of it, as of messages. A file that holds no document has a null one and the reason in `fault` ('empty', 'not
    JSON' or 'not an object'), so that files and rows can be told against each other. A missing folder gives no rows.
    """
    value = F.col("content").cast("string")
    document, blank = F.try_parse_json(value), F.length(F.regexp_replace(value, r"\s+", "")) == 0
    is_object = value.rlike(r"\A\s*\{")
    fault = F.when(blank, "empty").when(document.isNull(), "not JSON").when(~is_object, "not an object")
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no folder %s", path)
        return spark.createDataFrame([], "path string, document variant, fault string")
    scanned = files.withColumn("path", F.col("_metadata.file_path"))
    found = scanned.select("path", F.when(fault.isNull(), document).alias("document"), fault.alias("fault"))
    # a scan passes over files without a byte; the driver has listed them with the others
    listed = spark.createDataFrame([(name,) for name in files.inputFiles()], "path string")

    def plain(df: DataFrame) -> DataFrame:  # both name local files with a different number of slashes
        return df.withColumn("name", F.regexp_replace("path", "^([A-Za-z0-9+.-]+):/+", "$1:/"))

    without = plain(listed).join(plain(scanned.select("path")).select("name"), "name", "left_anti")
    return found.unionByName(without.select("path", F.lit(None).cast("variant").alias("document"), F.lit("empty").alias("fault")))


def scan_collection(spark: SparkSession, location: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """All documents of a collection: every run reads the full snapshot.

    ``fmt`` is any installed source; a document-database connector takes its connection in ``options``.
    """
    reader = spark.read.format(fmt).options(**options)
    return reader.load(location) if location else reader.load()
