"""Tables bucketed by their key: an upsert shuffles the new rows alone.

The rows of a version lie in a folder of ``n`` buckets by a hash of the key, which the
manifest names along with the number of buckets.  New rows are dealt into as many
partitions by the same hash, so each task joins a bucket of old rows, where they are,
with the new rows of its keys, and writes the bucket of the next version.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.sources import versions
from tickloom.sources.writers import WriteResult, _counted, keep_last
from tickloom.storage import stored


@contextmanager
def _named(spark: SparkSession) -> Iterator[str]:
    """A name in the session's catalog for as long as a plan or a write needs it; the files stay."""
    name = f"buckets_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _put(df: DataFrame, target: str, key: Sequence[str], buckets: int) -> str:
    """Write rows as buckets below the table; the folder."""
    folder = f"{versions.FILES}/{uuid.uuid4().hex}"
    with _named(df.sparkSession) as name:
        df.write.format("parquet").bucketBy(buckets, *key).sortBy(*key).option("path", f"{target.rstrip('/')}/{folder}").saveAsTable(name)
    return folder


def _scan(spark: SparkSession, target: str, schema: StructType, folder: str, key: Sequence[str], buckets: int) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    with _named(spark) as name:
        at = f"{target.rstrip('/')}/{folder}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) INTO {buckets} BUCKETS LOCATION '{at}'")
        # the plan is resolved here, and keeps the files and their buckets
        return spark.table(name)


def read_bucketed(spark: SparkSession, target: str) -> DataFrame:
    """The newest version; joins and groups by the key need no exchange of it."""
    version = versions.latest(spark, target)
    if version is None or "folder" not in version.details:
        raise FileNotFoundError(f"{target} has no buckets")
    return _scan(spark, target, version.struct(), version.details["folder"], version.unique, version.details["buckets"])


def upserted_buckets(old: DataFrame, new: DataFrame, key: Sequence[str], buckets: int, order: str | None = None) -> DataFrame:
    """Old rows, and in place of those whose key is among them the new rows; the last of the new rows by ``order``."""
    keyed = new.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"a row has no {k}")).cast(old.schema[k].dataType)).cast(old.schema[k].dataType) for k in key})
    dealt = keyed.repartition(buckets, *key)
    ranks: list[Column] = [F.col(order)] if order else []
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in new.columns))
    fresh = keep_last(dealt, [F.col(k) for k in key], [*ranks, tie]).select(*key, F.struct(*(F.col(f"`{c}`") for c in old.columns)).alias("new_"))
    had = old.select(*key, F.struct(*(F.col(f"`{c}`") for c in old.columns)).alias("old_"))
    # an exchange of the old rows would be the whole table's
    return had.join(fresh, list(key), "full_outer").select(F.coalesce("new_", "old_").alias("row_")).select("row_.*")


def upsert_bucketed(new: DataFrame, target: str, key: Sequence[str], buckets: int = 64, order: str | None = None, batch: tuple[str, int] | None = None) -> WriteResult:
    """Upsert rows into a bucketed table, made with the first rows; the number of buckets stays what it was then.

    Columns are those of the table; keys are cast to its types and may not be null.
    """
    spark = new.sparkSession
    version = versions.latest(spark, target)
    if version and tuple(key) != version.unique:
        raise ValueError(f"{target} is bucketed by {list(version.unique)}")
    before = version.rows if version else 0
    applied = dict(version.applied) if version else {}
    if batch:
        if applied.get(batch[0], batch[1] - 1) >= batch[1]:
            return WriteResult(before, 0, before)
        applied |= dict([batch])
    if version:
        buckets = version.details["buckets"]
        if missing := [c for c in version.struct().names if c not in new.columns]:
            raise ValueError(f"the rows lack {', '.join(missing)}")
    given, seen = _counted(new)
    rows = stored(given, "new-rows")
    old = read_bucketed(spark, target) if version else spark.createDataFrame([], new.schema)
    merged, kept = _counted(upserted_buckets(old, rows, key, buckets, order))
    folder = _put(merged, target, key, buckets)
    after = kept.get["n"]
    files = [f"{folder}/{f.partition(f'/{folder}/')[2]}" for f in versions._below(spark, f"{target.rstrip('/')}/{folder}")]
    versions.commit(spark, target, versions.next_version(version, schema=old.schema.json(), files=tuple(files), rows=after, unique=tuple(key), applied=applied, details={"buckets": buckets, "folder": folder}))
    return WriteResult(before, seen.get["n"], after, before + seen.get["n"] - after)
