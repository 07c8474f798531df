"""Landing of CSV files: each content once, broken lines apart, lineage kept.

A ledger holds what has been landed, by content: the number and bytes of a
file's lines and two order-free sums of their hashes, added up map-side, so a
file of any size is read in splits and two files of the same lines are the same
whatever their names. Files whose content the ledger has are not read again.

Rows are read as texts under the feed's schema. A line that does not fit it (too
few or too many columns, an open quote) is kept whole as a rejected row; all
other rows go on with the time of loading and the file that they came from.
``multi_line`` reads quoted line breaks; such a file cannot be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telco_mart.operators.runs import Run
from telco_mart.schemas import raw_schema
from telco_mart.sources.raw import with_lineage

CORRUPT, BROKEN_LINE = "_corrupt_record", "ligne illisible"
LEDGER = "feed string, digest string, file string, lines long, landed_at timestamp"


def file_digests(spark, path: str) -> DataFrame:
    """(file, digest, lines) of every file below ``path``."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    part = lambda seed: F.sum((F.xxhash64("value", F.lit(seed)) % F.lit(1 << 40)).cast("decimal(38,0)"))
    sums = lines.groupBy("file").agg(F.count("*").alias("lines"), F.sum(F.octet_length("value")).alias("bytes"), part(1).alias("a"), part(2).alias("b"))
    return sums.select("file", F.sha2(F.concat_ws(":", "lines", "bytes", "a", "b"), 256).alias("digest"), "lines")


def land(run: Run, feed: str, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """Land the files of one feed below ``path``. Returns (rows, broken): the new
    rows with ``_loaded_at`` and ``_source_file``, and the new rejected rows. The
    run holds both (``landed_<feed>``) and the ledger; they count once the
    caller commits it."""
    spark = run.spark
    seen = run.read("landing_ledger") if run.has("landing_ledger") else spark.createDataFrame([], LEDGER)
    found = file_digests(spark, path).groupBy("digest").agg(F.min("file").alias("file"), F.max("lines").alias("lines"))
    new = found.join(seen.filter(F.col("feed") == feed).select("digest").distinct(), "digest", "left_anti")
    entry = run.append("landing_ledger", new.select(F.lit(feed).alias("feed"), "digest", "file", "lines", F.current_timestamp().alias("landed_at")))
    # only this call's entries: those of this run and feed that were not there before
    files = [r.file for r in entry.filter(F.col("feed") == feed).join(seen.select("digest", "feed"), ["digest", "feed"], "left_anti").select("file").collect()]
    schema = T.StructType([*raw_schema(feed).fields, T.StructField(CORRUPT, T.StringType())])
    if files:
        reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        rows = reader.option("encoding", "UTF-8").option("multiLine", multi_line).option("escape", '"').csv(files)
    else:
        rows = spark.createDataFrame([], schema)
    rows = with_lineage(rows) if files else with_lineage(rows, "")
    name = f"landed_{feed}"
    run.append(name, rows)
    written = run.appended(name)  # read back: a scan of the files must not select the broken lines alone
    broken = written.filter(F.col(CORRUPT).isNotNull()).select(
        F.lit(feed).alias("source_table"), F.sha2(CORRUPT, 256).alias("record_id"), F.col(CORRUPT).alias("raw_data"),
        F.lit(BROKEN_LINE).alias("rejection_reason"), F.col("_loaded_at").alias("rejected_at"))
    return written.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), broken
