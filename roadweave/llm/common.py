"""Arrow plumbing shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from roadweave.runtime import BATCH_KEY, attach

#: Code points handled at once in a worker; a longer text makes a slice of its own.
SLICE_CHARS = 1_000_000


_KINDS = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType()}
_KINDS |= {f"array<{k}>": T.ArrayType(v) for k, v in _KINDS.items()}


def schema(fields: str) -> T.StructType:
    """``"name kind, name kind"`` as a schema, without a session (workers import this too)."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (f.split() for f in fields.split(","))])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return attach(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) and the named columns; other columns are dropped."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *more)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[dict[str, list]]:
    """The rows of ``batches`` as column lists, cut so that a slice has about ``SLICE_CHARS`` characters."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column(text).nbytes / batch.num_rows
        step = max(1, min(batch.num_rows, int(SLICE_CHARS / max(size, 1))))
        for k in range(0, batch.num_rows, step):
            part = batch.slice(k, step)
            yield {c: part.column(c).to_pylist() for c in part.schema.names}


def _give_back() -> None:
    """Freed memory goes back to the system, as idle workers hold it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_slices(df: DataFrame, make: Callable[[], Callable[[dict], dict]], out: T.StructType, text: str = "text", give_back: bool = False) -> DataFrame:
    """``make()`` runs once per task and gives a function from column lists to column lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(out)
        work = make()
        for cols in slices(batches, text):
            got = work(cols)
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in fields], schema=fields)
        if give_back:
            work = cols = got = None
            _give_back()

    return df.mapInArrow(run, out)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 64):
    """Arrow batches of few rows for what is run meanwhile: rows that hold many texts each fill memory by the default."""
    before = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows (all, if there are fewer), chosen by a hash of ``doc_id``; the bound holds at any size."""
    share = rows / max(1, docs.count())
    return docs if share >= 1 else docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 30)) < int(share * (1 << 30)))


class Bounded(dict):
    """A cache of two generations: at ``limit`` entries the young one becomes the old one, what is met again returns."""

    def __init__(self, make: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
