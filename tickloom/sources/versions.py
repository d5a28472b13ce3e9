"""Tables whose state is one manifest.

Files are written below ``_data`` under names of their own and never change.  A
version is a JSON manifest that names the files it consists of, put in place by one
rename that fails where the version is there already; readers take the newest.  So a
write shows whole or not at all, whatever it touches and wherever it stops, readers
keep the version they began with, and of two writers that start from one version the
second is refused.

A manifest also remembers which batches of which streams it holds, so that a batch
that comes again can be told apart in the same step that commits it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from typing import Any
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickloom.sources.layout import children, exists

MANIFESTS, FILES = "_versions", "_data"


class Conflict(RuntimeError):
    """Someone else has written the version meanwhile."""


@dataclass(frozen=True)
class Version:
    """files: below the table; applied: the last batch of each stream; unique: the key that no two rows share, if one is known."""

    number: int
    schema: str
    files: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    rows: int = 0
    unique: tuple[str, ...] = ()
    applied: Mapping[str, int] = field(default_factory=dict)
    details: Mapping[str, Any] = field(default_factory=dict)

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _java(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest(target: str, number: int) -> str:
    return f"{target.rstrip('/')}/{MANIFESTS}/{number:020d}.json"


def numbers(spark: SparkSession, target: str) -> list[int]:
    """The versions that are there, the oldest first."""
    found = (re.fullmatch(r"(\d{20})\.json", path.rsplit("/", 1)[-1]) for path, is_folder in children(spark, f"{target.rstrip('/')}/{MANIFESTS}") if not is_folder)
    return sorted(int(m[1]) for m in found if m)


def at(spark: SparkSession, target: str, number: int) -> Version:
    path, system = _java(spark, _manifest(target, number))
    stream = system.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    held = json.loads(text)
    return Version(**{k: tuple(v) if isinstance(v, list) else v for k, v in held.items()})


def latest(spark: SparkSession, target: str) -> Version | None:
    known = numbers(spark, target)
    return at(spark, target, known[-1]) if known else None


def commit(spark: SparkSession, target: str, version: Version) -> None:
    """Put the version's manifest in place, or raise ``Conflict`` where its number is taken."""
    final = _manifest(target, version.number)
    aside = f"{final.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    path, system = _java(spark, aside)
    stream = system.create(path)
    stream.write(bytearray(json.dumps(asdict(version)).encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(path, _java(spark, final)[0], none)
    except Exception as error:
        system.delete(path, False)
        if exists(spark, final):
            raise Conflict(f"version {version.number} of {target} is there already") from error
        raise


def label_of(file: str) -> str:
    """The partition of a file, as ``k=v/l=w``; empty without partitions."""
    parts = [p for p in file.split("/")[:-1] if p.startswith("part_") and "=" in p]
    return "/".join(unquote(p.removeprefix("part_")).replace("__HIVE_DEFAULT_PARTITION__", "") for p in parts)


def _below(spark: SparkSession, folder: str) -> list[str]:
    found = []
    for path, is_folder in children(spark, folder):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if not name.startswith(("_", ".")):
            found += _below(spark, path) if is_folder else [path] if name.endswith(".parquet") else []
    return found


def put(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> tuple[str, ...]:
    """Write rows aside; the names of their files, relative to the table, which no version holds as yet."""
    spark, folder = df.sparkSession, f"{FILES}/{uuid.uuid4().hex}"
    whole = f"{target.rstrip('/')}/{folder}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(whole)
    return tuple(f"{folder}/{p.partition(f'/{folder}/')[2]}" for p in _below(spark, whole))


def read_files(spark: SparkSession, target: str, schema: StructType, files: Sequence[str]) -> DataFrame:
    """The rows of some of a version's files; columns that a file lacks are null."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{target.rstrip('/')}/{_escaped(f)}" for f in files))


def _escaped(file: str) -> str:
    """A file's name where Spark expects a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


def read(spark: SparkSession, target: str, number: int | None = None, labels: Sequence[str] | None = None) -> DataFrame:
    """The rows of the newest version, or of an older one that is still there; ``labels`` picks partitions."""
    version = latest(spark, target) if number is None else at(spark, target, number)
    if version is None:
        raise AnalysisException(f"{target} has no version")
    files = version.files if labels is None else [f for f in version.files if label_of(f) in set(labels)]
    return read_files(spark, target, version.struct(), files)


def adopted(spark: SparkSession, target: str) -> Version | None:
    """What a folder holds: its newest version, or the files of a plain Parquet folder as version 0."""
    if (known := latest(spark, target)) or not exists(spark, target):
        return known
    root = target.rstrip("/")
    files = _below(spark, root)
    if not files:
        return None
    inside = [f[f.index(root.removeprefix("file:")) + len(root.removeprefix("file:")) + 1 :] for f in files]
    df = spark.read.option("mergeSchema", True).parquet(root)
    df = df.drop(*(c for c in df.columns if c.startswith("part_")))
    keys = tuple(p.partition("=")[0].removeprefix("part_") for p in inside[0].split("/")[:-1] if "=" in p)
    return Version(0, df.schema.json(), tuple(inside), keys, df.count())


def next_version(old: Version | None, **changes: Any) -> Version:
    if old is None:
        return Version(1, **changes)
    return replace(old, number=old.number + 1, **changes)


def vacuum(spark: SparkSession, target: str, keep: int = 1) -> int:
    """Delete all but the newest versions and the files that none of those kept names; the number of files deleted.

    Only for when no write is under way: its files aren't named as yet either.
    """
    known = numbers(spark, target)
    held = {f for n in known[-keep:] for f in at(spark, target, n).files}
    for n in known[:-keep]:
        path, system = _java(spark, _manifest(target, n))
        system.delete(path, False)
    gone, root = 0, f"{target.rstrip('/')}/{FILES}"
    for file in _below(spark, root) if exists(spark, root) else []:
        if f"{FILES}/{file.partition(f'/{FILES}/')[2]}" not in held:
            path, system = _java(spark, file)
            system.delete(path, False)
            gone += 1
    return gone
