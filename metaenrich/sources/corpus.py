"""Reading a corpus of gzipped JSON lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from .gzip_lines import SHAPE, read_gzip_lines

PATTERN = "*.jsonl.gz"
FILE = SHAPE.split("file ", 1)[1]
#: Session settings that the parsing relies on: last of repeated keys wins, an unreadable file costs only itself.
SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.files.ignoreCorruptFiles": "true",
    "spark.sql.files.ignoreMissingFiles": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@dataclass(frozen=True)
class Files:
    count: int
    failed: int
    examples: tuple[str, ...] = ()  # some of the failed ones, for the log


def list_files(spark: SparkSession, root: str, pattern: str = PATTERN) -> DataFrame:
    """(path, length, modified) of the files under root, recursively; hidden and empty ones are left out. Listed by Spark, without opening them."""
    configure(spark)
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        return source.load(root).select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")


def read_lines(spark: SparkSession, root: str, pattern: str = PATTERN) -> DataFrame:
    """(value, file): a row a line, and one with a verdict for each file; no files give no rows."""
    if list_files(spark, root, pattern).isEmpty():
        return spark.createDataFrame([], SHAPE)
    return read_gzip_lines(spark, root, pattern)


def judge_files(spark: SparkSession, verdicts: DataFrame, root: str, pattern: str = PATTERN) -> Files:
    """Counts the files, and those that couldn't be read to their end, from the verdicts (column file) of one read.

    A file without a verdict couldn't even be opened.
    """
    found = verdicts.where("file is not null").select("file.path", "file.damage")
    judged = list_files(spark, root, pattern).join(found.withColumn("seen", F.lit(True)), "path", "left")
    bad = judged.where("damage is not null or seen is null")
    some = bad.orderBy("path").limit(20).collect()
    return Files(judged.count(), bad.count() if len(some) == 20 else len(some), tuple(r.path for r in some))


def parse(lines: DataFrame, exact: bool = False) -> DataFrame:
    """(value, file, ok, record) of the lines that aren't blank; not ok: no single JSON value, or no valid UTF-8.

    With `exact`, lone surrogates and numbers beyond the doubles make a line bad, too.

    Rows with a file's verdict pass, with neither value nor ok. The parsed columns come out of a generator: a plain projection would be inlined into every later filter, which
    would parse each line several times.
    """
    if "file" not in lines.columns:
        lines = lines.withColumn("file", F.lit(None).cast(FILE))
    shown = lines.where(F.col("file").isNotNull() | ~F.is_valid_utf8("value") | ~R.is_blank(F.col("value")))
    return shown.select("value", "file", F.inline(F.array(R.strict(F.col("value"), exact))))
