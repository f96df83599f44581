"""Keyed upsert (insert-or-replace by key) into a table of versioned buckets.

Semantics (the pipeline's MERGE: matched -> update all, else insert all):

* the source is first cut to one row per key by a total order
  (``on_duplicate="error"`` raises instead);
* first write: the source is the table;
* later writes: target rows whose key is in the source are replaced.
  Keys compare with ``=``, so a null key never matches and a null-keyed row
  is inserted again each time; ``null_safe=True`` compares with ``<=>``;
* ``newest_wins=True`` keeps, per key, the row with the greatest ``order_by``
  among stored and incoming rows, so late, older rows cannot overwrite newer ones;
* columns are merged and types widened: rows written before a column (or a
  struct field) came hold null in it.

Storage: rows lie in ``pmod(xxhash64(keys), buckets)``, which depends on no
time zone or clock.  (Rows with a null key match nothing and are spread by all
their columns, unless ``null_safe``.)  A batch reads the buckets its keys fall
in, merges them and writes them once, into a new folder; then one small file
under ``_versions`` names the live folder of every bucket.  Readers resolve the
newest such file, so they see one whole version, before or after; nothing is
changed in place.  The file also holds what fixes the layout (keys, bucket
number, null rule), which every write checks, the merged schema, and for each
*writer* (a streaming query or a job) the last batch number it committed: a
batch of that writer up to this number is a replay and changes nothing, while
other writers and new checkpoints have numbers of their own.  Two writers that
commit the same version number at once: one of them starts over.

With a catalog table format that supports MERGE (Delta, Iceberg),
``merge_into`` issues the same operation natively instead.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wiremap import fs
from wiremap.operators.latest import latest_by_key, one_per_key
from wiremap.session import FREE_SHUFFLES, settings
from wiremap.sources.evolving import widen

BUCKET = "__bucket"
HASH_BUCKETS = 16
RETRIES = 5
KEEP_HOURS = 24.0
#: Row groups of rows that go to all buckets at once, so that a task holds little of each.
SPREAD_GROUP = 8 << 20


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, ascending."""
    names = fs.list_names(spark, f"{path}/_versions")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _version(spark: SparkSession, path: str, v: int) -> dict:
    return json.loads(fs.read_text(spark, f"{path}/_versions/{v:012d}.json"))


def _current(spark: SparkSession, path: str) -> dict | None:
    found = versions(spark, path)
    return _version(spark, path, found[-1]) if found else None


def _folder(path: str, folder: str, bucket: int | str) -> str:
    return f"{path}/data/{folder}/{BUCKET}={bucket}"


def _read(spark: SparkSession, path: str, about: dict, buckets=None,
          schema: T.StructType | None = None) -> DataFrame:
    schema = schema or T.StructType.fromJson(about["schema"])
    live = [_folder(path, f, b) for b, f in about["live"].items() if buckets is None or int(b) in buckets]
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*live)


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest committed version; None if there is none yet."""
    about = _current(spark, path)
    return None if about is None else _read(spark, path, about)


def bucket_of(keys: Sequence[str], buckets: int, columns: Sequence[str] = (),
              null_safe: bool = False) -> F.Column:
    own = F.xxhash64(*[F.col(k) for k in keys])
    if not null_safe and columns:
        absent = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
        own = F.when(absent, F.xxhash64(*[F.col(c) for c in columns])).otherwise(own)
    return F.pmod(own, F.lit(buckets)).cast("int")


def reduce_source(source: DataFrame, keys: Sequence[str], order_by: str | None = None,
                  on_duplicate: str = "first") -> DataFrame:
    if on_duplicate == "trusted":
        return source
    if on_duplicate == "error":
        dup = source.groupBy(*keys).count().filter(F.col("count") > 1).limit(1)
        if dup.count():
            raise ValueError(f"upsert source has several rows for one key {list(keys)}")
        return source
    if on_duplicate != "first":
        raise ValueError("on_duplicate must be 'first' or 'error'")
    if order_by:
        return latest_by_key(source, keys, order_by)
    return one_per_key(source, keys)


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 null_safe: bool = False, newest_wins: bool = False,
                 order_by: str | None = None) -> DataFrame:
    """The upserted table as a DataFrame (no write)."""
    if newest_wins:
        if not order_by:
            raise ValueError("newest_wins needs order_by")
        both = target.unionByName(source, allowMissingColumns=True)
        return latest_by_key(both, keys, order_by)
    t, s = target.alias("t"), source.select(*keys).alias("s")
    eq = [(F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if null_safe
           else F.col(f"t.{k}") == F.col(f"s.{k}")) for k in keys]
    kept = t.join(s, eq, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], *,
           batch_id: int | None = None, writer: str = "default", order_by: str | None = None,
           null_safe: bool = False, newest_wins: bool = False,
           on_duplicate: str = "first", keep_hours: float = KEEP_HOURS, keep: int = 2, buckets: int | None = None,
           unique_keys: bool = False, spread: bool = False) -> int:
    """Upsert ``source`` into the table at ``path``; returns the current version.

    With a ``batch_id`` the write is a no-op if this ``writer`` has committed
    that number or a later one.  ``buckets`` (default ``HASH_BUCKETS``) is fixed
    by the first write.  ``unique_keys=True`` is the caller's promise that
    ``source`` already has one row per key, which skips the reduction.  Versions
    stay for ``keep_hours`` after a later one took their place (and the newest
    ``keep`` always), so that a reader of an older one can finish.

    A first write goes straight to its buckets; later ones stage the source, as
    the merge reads it twice.  With ``spread`` the rows of a first write aren't
    shuffled by bucket: each task that has computed some writes them to all
    buckets (more files, but no second copy of a large result on the disks).
    """
    src = reduce_source(source, keys, order_by, "trusted" if unique_keys else on_duplicate)
    stage = None
    try:
        for _ in range(RETRIES):
            found = versions(spark, path)
            about = _version(spark, path, found[-1]) if found else None
            if about is not None:
                _check_layout(path, about, keys, buckets, null_safe)
                if batch_id is not None and about["writers"].get(writer, -1) >= batch_id:
                    return found[-1]
            n = about["buckets"] if about else (buckets or HASH_BUCKETS)
            old = T.StructType.fromJson(about["schema"]) if about else None
            schema = widen(old, src.schema)
            folder, v = uuid.uuid4().hex, (found[-1] + 1 if found else 0)
            data = f"{path}/data/{folder}"
            if about is None:
                touched = set()
                placed = src.withColumn(BUCKET, bucket_of(keys, n, src.columns, null_safe))
                _write_buckets(placed, data, n, spread)
            else:
                if stage is None:
                    # The source is computed once, however often the merge reads it.
                    stage = f"{path}/_staging/{uuid.uuid4().hex}"
                    with settings(spark, FREE_SHUFFLES):
                        src.write.parquet(stage)
                placed = spark.read.schema(schema).parquet(stage).withColumn(
                    BUCKET, bucket_of(keys, n, src.columns, null_safe))
                touched = {r[0] for r in placed.select(BUCKET).distinct().collect()}  # at most n numbers
                if touched and any(old[k].dataType != schema[k].dataType for k in keys):
                    touched = set(range(n))  # a wider key hashes differently
                target = _read(spark, path, about, touched, schema)
                merged = merge_frames(target, placed.drop(BUCKET), keys, null_safe, newest_wins, order_by)
                if touched:
                    _write_buckets(merged.withColumn(BUCKET, bucket_of(keys, n, schema.names, null_safe)), data, n)
            live = dict(about["live"]) if about else {}
            names = fs.list_names(spark, data)
            written = [m.split("=")[1] for m in names if m.startswith(f"{BUCKET}=")]
            if not written:
                fs.delete(spark, data)
            live = {b: f for b, f in live.items() if int(b) not in touched} | dict.fromkeys(written, folder)
            after = {"keys": list(keys), "buckets": n, "null_safe": null_safe, "live": live,
                     "schema": schema.jsonValue(), "at": time.time(), "writers": dict(about["writers"]) if about else {}}
            if batch_id is not None:
                after["writers"][writer] = batch_id
            if fs.write_new(spark, f"{path}/_versions/{v:012d}.json", json.dumps(after)):
                _drop_old(spark, path, keep, keep_hours)
                return v
            fs.delete(spark, data)
        raise RuntimeError(f"{path}: {RETRIES} other writers committed first")
    finally:
        if stage is not None:
            fs.delete(spark, stage)


def _check_layout(path: str, about: dict, keys: Sequence[str], buckets: int | None, null_safe: bool) -> None:
    asked = {"keys": list(keys), "buckets": buckets or about["buckets"], "null_safe": null_safe}
    for name, value in asked.items():
        if about[name] != value:
            raise ValueError(f"{path}: the table has {name}={about[name]!r}, not {value!r}")


def _write_buckets(rows: DataFrame, path: str, n: int, spread: bool = False) -> None:
    """Write rows below ``path`` by their bucket of ``n``."""
    spark, asked = rows.sparkSession, FREE_SHUFFLES
    writer = (rows if spread else _clustered(rows)).write.partitionBy(BUCKET)
    if spread:
        # one open file a bucket instead of sorting (and spilling) a task's rows; at the limit itself Spark would sort
        asked = asked | {"spark.sql.maxConcurrentOutputFileWriters": str(n + 1), "spark.sql.optimizer.plannedWrite.enabled": "false"}
        writer = writer.option("parquet.block.size", str(SPREAD_GROUP))
    with settings(spark, asked):
        writer.parquet(path)


def _clustered(df: DataFrame) -> DataFrame:
    """Group rows by bucket before writing (few files per bucket).

    The ``rebalance`` hint lets AQE split a bucket that holds too many rows
    over several tasks and merge small ones.
    """
    return df.hint("rebalance", BUCKET)


def _drop_old(spark: SparkSession, path: str, keep: int, keep_hours: float) -> None:
    """Remove versions that were replaced more than ``keep_hours`` ago, and the folders only they name."""
    found = versions(spark, path)
    about = {found[-1]: _version(spark, path, found[-1])}
    old: list[int] = []
    # From the oldest on: the first version that has to stay ends the search.
    for v, after in zip(found[:-max(keep, 1)], found[1:]):
        about[after] = _version(spark, path, after)
        if about[after].get("at", 0) > time.time() - keep_hours * 3600:
            break
        old.append(v)
    if not old:
        return
    for v in found:
        about[v] = about.get(v) or _version(spark, path, v)
    used = {(b, f) for v in found if v not in old for b, f in about[v]["live"].items()}
    for v in old:
        for b, f in about[v]["live"].items():
            if (b, f) not in used:
                fs.delete(spark, _folder(path, f, b))
        fs.delete(spark, f"{path}/_versions/{v:012d}.json")


def merge_into(source: DataFrame, table: str, keys: Sequence[str], null_safe: bool = False) -> None:
    """Native MERGE for catalog tables whose format supports it (Delta, Iceberg)."""
    op = "<=>" if null_safe else "="
    cond = " AND ".join(f"{table}.`{k}` {op} s.`{k}`" for k in keys)
    (source.alias("s").mergeInto(table, F.expr(cond))
     .whenMatched().updateAll().whenNotMatched().insertAll().merge())
