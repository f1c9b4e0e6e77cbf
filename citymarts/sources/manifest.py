"""Which evidence files are new: a listing against the files of earlier loads.

The listing reads no content (path, size and time of change come from the
file system); only files that no committed load holds are ever opened.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from citymarts.sources.envelopes import SOURCES, parse_envelopes

FILES = StructType(
    [
        StructField("source_folder", StringType()),
        StructField("path", StringType()),
        StructField("size", LongType()),
        StructField("changed_at", LongType()),
    ]
)
FILE_KEY = ["path", "size", "changed_at"]
#: Files opened by one load; their paths pass through the driver.
FILES_PER_LOAD = 100_000
#: <root>/<source>/<scope>/YYYY/MM/DD/<file>.json -> <scope>
_SCOPE = r"/([^/]+)/[0-9]{4}/[0-9]{2}/[0-9]{2}/[^/]+$"


def scope_of(path: str) -> Column:
    """Scope of a file by its folder; empty if the folders are not laid out so."""
    return F.regexp_extract(path, _SCOPE, 1)


def list_files(spark: SparkSession, root: str, sources: Sequence[str] = SOURCES) -> DataFrame:
    """``FILES`` rows of every ``*.json`` under the source folders; a missing folder gives none.

    The binary file source is asked for its metadata columns only, so no file
    is opened.
    """
    out = spark.createDataFrame([], FILES)
    for source in sources:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        try:
            found = reader.load(f"{root.rstrip('/')}/{source}")
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                continue
            raise
        listed = found.select(
            F.lit(source).alias("source_folder"), "path", F.col("length").alias("size"), F.unix_micros("modificationTime").alias("changed_at")
        )
        out = out.unionByName(listed)
    return out


def new_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files that no load holds as they are now (a file written anew is new)."""
    return listed.join(known.select(*FILE_KEY), FILE_KEY, "left_anti").select(*FILES.fieldNames())


def known_per_scope(listed: DataFrame, known: DataFrame) -> DataFrame:
    """``source, scope_id, files`` of the files that are not opened again, from their paths alone."""
    seen = listed.join(known.select(*FILE_KEY).distinct(), FILE_KEY, "left_semi")
    return seen.groupBy(F.col("source_folder").alias("source"), scope_of("path").alias("scope_id")).agg(F.count("*").alias("files"))


def in_loads(files: DataFrame, per_load: int = FILES_PER_LOAD) -> Iterator[list]:
    """All rows of ``files``, in lists of at most ``per_load`` (one partition at a time on the driver)."""
    rows = files.toLocalIterator()
    while part := list(islice(rows, per_load)):
        yield part


def open_files(spark: SparkSession, files: Sequence) -> DataFrame:
    """Envelopes of just these files (rows of ``FILES``), parsed once, tagged with ``rule``.

    ``rule`` is NULL for a usable envelope, else why it is not
    (``invalid_json``, ``incomplete_envelope``).
    """
    out = None
    for source in sorted({f["source_folder"] for f in files}):
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", f["path"]) for f in files if f["source_folder"] == source]  # no patterns
        part = spark.read.text(paths, wholetext=True).select(
            "value", F.col("_metadata.file_path").alias("raw_file_path"), F.lit(source).alias("source_folder")
        )
        out = part if out is None else out.unionByName(part)
    env = parse_envelopes(out)
    rule = F.when(~F.col("_ok"), F.when(F.col("_bad_json"), "invalid_json").otherwise("incomplete_envelope"))
    return env.select(
        "source", "checksum", "scope_id", "payload", "ingested_at", "raw_file_path", rule.alias("rule"), F.when(~F.col("_ok"), F.col("value")).alias("value")
    )
