"""Copy on write by partition: a change rewrites only the partitions that hold its rows.

A change is a set of complete rows by key.  Its folder in the shared directory holds the new rows, the
rows they replace, and the new content of every partition concerned; only then are the folders of these
partitions exchanged, one after the other.  A change that broke off is published again from its folder
(``publish``), and a finished one is undone by key (``undo``), also after later changes of other rows.

Which partitions are concerned is found by a join of the keys with the table that reads the key
column only.  The list of partitions is bounded by the calendar or by the number of buckets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path, tidy

BUCKET = "_bucket"
_FILE, _SIDE = "_held_in", "_side"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Rewrite:
    """What a change did, and where its folder is."""

    folder: str
    path: str
    key: tuple[str, ...]
    partition: str | None
    partitions: tuple[str | None, ...]
    emptied: tuple[str | None, ...]
    files: int
    rows: int
    rows_at: str = ""


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """Partition of a table without a date: a hash of its key."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string")


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def create(rows: DataFrame, path: str, partition: str | None) -> None:
    """The first version of a table."""
    writer = rows.hint("rebalance", partition).write.partitionBy(partition) if partition else rows.write
    _save(writer, path)


def _write(rows: DataFrame, path: str) -> None:
    _save(rows.write, path)


def _save(writer: DataFrameWriter, path: str, mode: str = "overwrite") -> None:
    with tidy(writer._spark):
        writer.mode(mode).option("compression", "zstd").parquet(path)


def _in(partition: str, values: Sequence[str | None]) -> Column:
    """Rows of some partitions; a filter that prunes, and that knows the partition without a value."""
    known = [v for v in values if v is not None]
    found = F.col(partition).isin(known) if known else F.lit(False)
    return found | F.col(partition).isNull() if None in values else found


def replace_rows(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    key: Sequence[str],
    partition: str | None,
    removed: DataFrame | None = None,
    folder: str | None = None,
    rows_at: str | None = None,
    covered: bool = False,
    by_key: bool = False,
) -> Rewrite:
    """Put complete rows in the place of the rows with their keys, and take out the ``removed`` keys.

    New keys are added.  A row whose partition changes moves.  Rows with a null key are never
    replaced.  With the ``folder`` of an earlier call that broke off nothing is computed again.  Rows that
    are stored already are not copied if ``rows_at`` names their folder.

    ``covered`` says that the ``removed`` keys are distinct and hold the keys of all new rows; then these
    need no copy of their own but are written where they are staged.  ``by_key`` says that the partition
    follows from the key, so that the table need not be asked where its rows are (nor in how many files).

    The partitions concerned are read whole once: one join splits them into the rows that go and those
    that stay.  An empty table is not joined.
    """
    spark, key = rows.sparkSession, list(key)
    folder = folder or fresh_path(spark, "change")
    earlier = resume(spark, folder)
    if earlier is not None:
        return earlier
    covered = covered and removed is not None and rows_at is None
    if covered:
        rows_at = ""
        _stage(rows.select(*schema.fieldNames()), folder, partition)
        new = read_rows(spark, _staged(folder), schema)
    else:
        if rows_at is None:
            rows_at = f"{folder}/rows"
            _write(rows.select(*schema.fieldNames()), rows_at)
        new = read_rows(spark, rows_at, schema)
    keys = new.select(*key)
    if removed is not None:
        if not covered or not finished(spark, f"{folder}/removed"):
            _write(removed.select(*key), f"{folder}/removed")
        gone = read_rows(spark, f"{folder}/removed", keys.schema)
        keys = gone if covered else keys.unionByName(gone)
    keys = keys if covered else keys.distinct()

    current = read_rows(spark, path, schema)
    empty = current.isEmpty()
    place = F.lit(None) if partition is None else F.col(partition)
    place = place.cast("string").alias("place")
    sides = new.select(place, F.lit(None).cast("long").alias(_FILE))
    if not empty and not by_key:
        # The key column only, and one number for the name of a file.
        held = current.select(*[F.col(k).alias(f"_key_{k}") for k in key], place, F.xxhash64("_metadata.file_path").alias(_FILE))
        same = [F.col(f"_key_{k}") == F.col(k) for k in key]
        sides = sides.unionByName(held.join(keys, same, "left_semi").select("place", _FILE))
    counts = sides.groupBy("place").agg(F.count_distinct(_FILE), F.count(_FILE)).collect()
    touched: list[str | None] = []
    if partition is not None:
        touched = sorted((r[0] for r in counts), key=lambda v: (v is None, v))
        current = current.where(_in(partition, touched))
    emptied = []
    if counts and not covered:
        _stage(new, folder, partition)
    if counts and not empty:
        goes = keys.withColumn(_SIDE, F.lit("before"))
        split = current.join(goes, key, "left").withColumn(_SIDE, F.coalesce(_SIDE, F.lit("after")))
        split = split.select(*schema.fieldNames(), _SIDE)
        by = [_SIDE] if partition is None else [_SIDE, partition]
        _save(split.hint("rebalance", *by).write.partitionBy(*by), f"{folder}/split", "append")
    if counts:
        names = {v: f"{partition}={_NO_VALUE if v is None else v}" for v in touched}
        emptied = [v for v in touched if not exists(spark, f"{_staged(folder)}/{names[v]}")]
    files, held_rows = sum(r[1] for r in counts), sum(r[2] for r in counts)
    if by_key and counts and not empty:
        side = f"{folder}/split/{_SIDE}=before"
        held_rows = read_rows(spark, side, schema).count() if exists(spark, side) else 0
    change = Rewrite(folder, path, tuple(key), partition, tuple(touched), tuple(emptied), files, held_rows, rows_at)
    _note(spark, f"{folder}/record", json.dumps(asdict(change) | {"schema": schema.json()}))
    publish(spark, change, schema)
    return change


def _stage(new: DataFrame, folder: str, partition: str | None) -> None:
    """New rows where they are published from; what an attempt that broke off left there goes."""
    left, store = _hadoop(new.sparkSession, f"{folder}/split")
    store.delete(left, True)
    staged = new.write if partition is None else new.hint("rebalance", partition).write.partitionBy(partition)
    _save(staged, _staged(folder))


def _staged(folder: str) -> str:
    return f"{folder}/split/{_SIDE}=after"


def _hadoop(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, store = _hadoop(spark, path)
    return store.exists(found)


def _note(spark: SparkSession, path: str, text: str) -> None:
    """Write a line beside the data; the marker of success comes last."""
    for name, line in (("part-0", text), ("_SUCCESS", "")):
        found, store = _hadoop(spark, f"{path}/{name}")
        out = store.create(found, True)
        out.write(bytearray(line.encode()))
        out.close()


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def once(df: DataFrame, path: str) -> DataFrame:
    """Write a frame unless an earlier attempt did, and read it back."""
    if not finished(df.sparkSession, path):
        _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recorded(spark: SparkSession, folder: str) -> tuple[Rewrite, T.StructType] | None:
    """The change of a folder, if it was computed to its end."""
    if not finished(spark, f"{folder}/record"):
        return None
    values = json.loads(spark.read.text(f"{folder}/record").first()[0])
    schema = T.StructType.fromJson(json.loads(values.pop("schema")))
    values |= {"key": tuple(values["key"]), "partitions": tuple(values["partitions"]), "emptied": tuple(values["emptied"])}
    return Rewrite(**values), schema


def resume(spark: SparkSession, folder: str) -> Rewrite | None:
    """The change of a folder, published if it had not been; nothing if it was never computed."""
    found = recorded(spark, folder)
    if found is None:
        return None
    if not finished(spark, f"{folder}/done"):
        publish(spark, *found)
    return found[0]


def publish(spark: SparkSession, change: Rewrite, schema: T.StructType) -> None:
    """Bring the new content of the partitions into the table; may be repeated."""
    staged = _staged(change.folder)
    if change.partition is None:
        if exists(spark, staged):
            create(read_rows(spark, staged, schema), change.path, None)
    for value in change.partitions:
        name = f"{change.partition}={_NO_VALUE if value is None else value}"
        old, store = _hadoop(spark, f"{change.path}/{name}")
        new, _ = _hadoop(spark, f"{staged}/{name}")
        # What is no longer staged was moved by an earlier attempt, unless no row was left.
        if value in change.emptied:
            store.delete(old, True)
        elif store.exists(new):
            store.delete(old, True)
            if not store.rename(new, old):
                raise RuntimeError(f"{name} was not moved into {change.path}")
    _note(spark, f"{change.folder}/done", "published")


def before(spark: SparkSession, change: Rewrite) -> DataFrame:
    """The rows that a change replaced."""
    _, schema = recorded(spark, change.folder)
    path = f"{change.folder}/split/{_SIDE}=before"
    return read_rows(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def undo(spark: SparkSession, change: Rewrite, columns: Sequence[str] = ()) -> Rewrite:
    """Bring back the rows that a change replaced, and take out those that it added.

    With ``columns`` only these get their old values, so later changes of other columns of the same
    rows stay; rows that have gone since stay gone.
    """
    _, schema = recorded(spark, change.folder)
    old, key = before(spark, change), list(change.key)
    if columns:
        saved = old.select(*key, *[F.col(c).alias(f"_old_{c}") for c in columns]).distinct()
        now = read_rows(spark, change.path, schema).join(saved, key)
        rows = now.withColumns({c: F.col(f"_old_{c}") for c in columns}).select(*schema.fieldNames())
        return replace_rows(rows, change.path, schema, key, change.partition)
    parts = [read_rows(spark, change.rows_at, schema).select(*key)] if change.rows_at else []
    if finished(spark, f"{change.folder}/removed"):
        only = T.StructType([schema[k] for k in key])
        parts.append(read_rows(spark, f"{change.folder}/removed", only))
    keys = parts[0].unionByName(parts[-1]) if len(parts) > 1 else parts[0]
    return replace_rows(old, change.path, schema, key, change.partition, removed=keys)
