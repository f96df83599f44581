"""Parquet folders whose files gain columns and wider types over time.

A file stream has one schema for its whole life, so a column that comes in a
later file would be lost without a word.  Here the stream carries only file
paths (``new_files``), and each micro-batch reads its own files under the
schema that their own footers merge to (``read_files``): columns are united by
name, struct fields too, and types widened where no value can change.  Footers
are merged by Spark's tasks; only file names pass through the driver, as in any
file stream.

Types widen byte -> short -> int -> long, float -> double, byte/short/int ->
double, decimal -> wider decimal and date -> timestamp without time zone; any
other disagreement stops the batch before its files count as done.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wiremap import fs
from wiremap.session import list_cheaply

#: Columns of Spark's binary file source; only the path is read, never a file's content.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: What opening a file counts when files are dealt to tasks (Spark's 4 MB would be a task for some small files).
OPEN_COST = 64 << 10
#: A file source forgets files this much older than the newest one it has seen.
MAX_FILE_AGE = "365d"


class TypeConflict(ValueError):
    """Two files hold a column under types of which neither can hold the other."""


def widen_type(a: T.DataType, b: T.DataType, where: str = "") -> T.DataType:
    """The narrowest type that holds every value of ``a`` and ``b`` unchanged."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widen(a, b, f"{where}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen_type(a.elementType, b.elementType, f"{where}[]"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widen_type(a.keyType, b.keyType, f"{where}.key"),
                         widen_type(a.valueType, b.valueType, f"{where}.value"), True)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    for x, y in ((a, b), (b, a)):
        if isinstance(x, WHOLE) and isinstance(y, WHOLE) and WHOLE.index(type(x)) <= WHOLE.index(type(y)):
            return y
        if isinstance(y, T.DoubleType) and isinstance(x, (T.FloatType, *WHOLE[:3])):
            return y
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
        if isinstance(x, T.NullType):
            return y
    raise TypeConflict(f"column {where or '?'} is {a.simpleString()} in one file and {b.simpleString()} in another")


def widen(old: T.StructType | None, new: T.StructType, where: str = "") -> T.StructType:
    """Fields of ``old`` in their order, then new ones; all nullable, as some rows lack them."""
    fields = {f.name.lower(): f for f in (old.fields if old is not None else [])}
    for f in new.fields:
        have = fields.get(f.name.lower())
        kind = f.dataType if have is None else widen_type(have.dataType, f.dataType, where + f.name)
        fields[f.name.lower()] = T.StructField((have or f).name, kind, True)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.values()])


def _literal(path: str) -> str:
    """A path that globbing takes as it is."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def files_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType:
    """The merged, widened schema of Parquet files.

    Spark merges the footers of all files in tasks.  It takes no two types for
    one column, so files that disagree are halved until each part agrees.
    """
    try:
        found = spark.read.option("mergeSchema", "true").parquet(*[_literal(p) for p in paths]).schema
        return widen(None, found)
    except (PySparkException, Py4JJavaError) as e:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(paths) // 2
    return widen(files_schema(spark, paths[:half]), files_schema(spark, paths[half:]))


def read_files(spark: SparkSession, paths: Sequence[str], needed: T.StructType | None = None) -> DataFrame:
    """All rows of the files under their merged schema; columns of ``needed`` that no file holds are null."""
    schema = files_schema(spark, paths)
    if needed is not None:
        have = {f.name.lower() for f in schema.fields}
        schema = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType, True) for f in needed.fields
                                                 if f.name.lower() not in have]])
    return scan(spark, paths, schema)


def scan(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The files under a given schema: Spark's reader widens types and fills absent columns with null."""
    return spark.read.schema(schema).parquet(*[_literal(p) for p in paths])


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a folder (none: empty); names that begin with . or _ are no data."""
    if not fs.exists(spark, path):
        return []
    list_cheaply(spark, path)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path))
    return _paths(files)


def _paths(files: DataFrame) -> list[str]:
    """The paths of a binary file source, sorted; read in few tasks, as none opens its files."""
    few = files.select("path").coalesce(2 * files.sparkSession.sparkContext.defaultParallelism)
    return sorted(few.toArrow()["path"].to_pylist())


def new_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
              max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """The paths of a folder's Parquet files as an unbounded table; the folder may still be empty."""
    fs.mkdirs(spark, path)
    list_cheaply(spark, path)
    reader = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .option("maxFileAge", max_file_age))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select("path")


def start_files(files: DataFrame, run: Callable[[SparkSession, list[str], int], None], checkpoint: str, *,
                available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Call ``run(session, paths, batch number)`` for each micro-batch of ``new_files``.

    The session is the query's own, set to read many small files in few tasks.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        paths = _paths(df)  # one name per new file
        if paths:
            df.sparkSession.conf.set("spark.sql.files.openCostInBytes", str(OPEN_COST))
            run(df.sparkSession, paths, batch_id)

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
