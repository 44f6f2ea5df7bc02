"""Shared pieces of the document operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run without space, tab, newline, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BATCH = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_array(text: Column) -> Column:
    """The words of a text; no words for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def crc32_of_id(id_column: Column) -> Column:
    """Checksum of an id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Bound the rows of an Arrow batch, so that a worker holds few long texts at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def pieces_of(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches where the bytes of one column reach a bound; a single long text stays whole."""
    for batch in batches:
        offsets = batch.column(column).cast(pa.large_binary()).buffers()[1]
        if batch.num_rows <= 1 or offsets is None or batch.column(column).nbytes <= max_bytes:
            if batch.num_rows:
                yield batch
            continue
        sizes = [len(x or b"") for x in batch.column(column).cast(pa.large_binary()).to_pylist()]
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def hash_sample(df: DataFrame, key: str, label: str, per_class: int, seed: str) -> tuple[list[Any], dict[Any, int]]:
    """About ``per_class`` rows of each value of ``label``, chosen by a seeded hash of ``key``, and the sizes of all classes.

    Collects a bounded sample for the driver, in an order that does not depend on partitions.
    """
    buckets = 1 << 20
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if not sizes:
        return [], {}
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets))
    limit = F.lit(0)
    for value, size in sorted(sizes.items(), key=lambda x: str(x[0])):
        limit = F.when(F.col(label) == F.lit(value), F.lit(min(buckets, math.ceil(buckets * per_class / size)))).otherwise(limit)
    rows = df.where(draw < limit).collect()
    return sorted(rows, key=lambda r: (str(r[key]), str(r))), sizes


def class_sample(df: DataFrame, label: str, text: str, per_class: int, most_words: int, seed: str) -> list[Any]:
    """At most ``per_class`` distinct rows of each value of ``label``, with whole texts, drawn by a seeded hash of all columns.

    A class takes rows in the order of the draw until it has ``most_words`` words.  Equal rows are drawn
    once, however many there are, so the result is bounded by its parameters for every input.
    """
    space = float(1 << 52)
    draw = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(1 << 52))
    words = F.size(F.split(text, r"[\x20\x09-\x0D]+"))
    drawn = df.withColumn("draw_", draw)
    sizes = drawn.groupBy(label).agg(F.approx_count_distinct("draw_").alias("rows_"))
    # Four times as many as needed, so that the classes fill up; few rows are then ranked.  The sizes are
    # one row per class of a model.  Without the hint all texts could be shuffled by class.
    near = drawn.join(F.broadcast(sizes), label).where(F.col("draw_") < F.lit(space * 4 * per_class) / F.col("rows_"))
    once = near.groupBy(label, "draw_").agg(F.first(F.struct(*df.columns)).alias("row_"), F.first(words).alias("words_"))
    order = Window.partitionBy(label).orderBy("draw_")
    before = F.coalesce(F.sum("words_").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = once.withColumns({"nth_": F.row_number().over(order), "before_": before})
    kept = ranked.where((F.col("nth_") <= per_class) & (F.col("before_") < most_words))
    return [r["row_"] for r in sorted(kept.select("row_", "draw_", label).collect(), key=lambda r: (str(r[label]), r["draw_"]))]


def char_grams(words: list[str], lengths: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of words: buckets, and the word of each, in order."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(code):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))
    code = np.concatenate([code, np.zeros(max(lengths), np.uint64)])
    n = len(owner)
    ids = np.empty((n, len(lengths)), np.int64)
    value, done = np.zeros(n, np.uint64), 0
    for k, length in enumerate(sorted(lengths)):
        for j in range(done, length):
            value = (value ^ code[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        done = length
        ids[:, k] = (value ^ (value >> np.uint64(32))) % np.uint64(buckets)
    valid = left[:, None] >= np.array(sorted(lengths))
    return ids[valid], np.repeat(owner, valid.sum(axis=1))


def sums_by(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows of values by owner, which is sorted."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(owner):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[first]] = np.add.reduceat(values, first, axis=0)
    return out


class WordTable:
    """Rows of numbers for words, computed once per distinct word and kept by a worker."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], limit: int = 250_000) -> None:
        self.compute, self.limit = compute, limit
        first = compute([""])  # row 0 stands for "no word"
        self.rows = np.zeros((1024, first.shape[1]), first.dtype)
        self.rows[0] = first[0]
        self.place: dict[str, int] = {}

    def lookup(self, words: list[str]) -> np.ndarray:
        """Row numbers of words; they hold until the next call."""
        place = self.place
        if len(place) > self.limit:
            place.clear()
        numbers = np.array([place.get(w, -1) for w in words], np.int64)
        missing = np.flatnonzero(numbers < 0).tolist()
        if missing:
            start = len(place) + 1
            new = list(dict.fromkeys([words[i] for i in missing]))
            place.update(zip(new, range(start, start + len(new)), strict=True))
            while len(self.rows) < start + len(new):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            for i in range(0, len(new), 20_000):  # bounds the memory of one computation
                part = new[i : i + 20_000]
                self.rows[start + i : start + i + len(part)] = self.compute(part)
            numbers[missing] = [place[words[i]] for i in missing]
        return numbers
