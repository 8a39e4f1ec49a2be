"""Helpers shared by the training-data operators: inputs, hold-out rule, shared-folder tables."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import telemetra
from telemetra.session import checkpoint_dir

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def held_out(doc_id: str, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == rest, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` (fast) is used where the text has no other upper-case letter."""
    other = text.rlike(r"[[\p{IsUppercase}\p{Lt}]&&[^A-Z]]")
    return F.when(other, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_hashes(hashes: Column, size: int) -> Column:
    """Hash of each run of ``size`` elements of an array of word hashes (shorter arrays: none)."""
    return let(hashes, lambda h: F.when(F.size(h) >= size, F.transform(
        F.sequence(F.lit(0), F.size(h) - size),
        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))).otherwise(F.array().cast("array<bigint>")))


def split_words(text: Column, between: str) -> Column:
    """The non-empty parts of a text (null: none) between matches of a pattern, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), between), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet under the cluster's shared folder and reads it back: cuts the
    lineage and computes expensive rows once."""
    spark = df.sparkSession
    path = posixpath.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


#: Rows that Spark hands to a Python task at once, where the session has its default (10,000): texts are long.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, so that tasks can import it wherever
    they run (a cluster started with --py-files has it already; a second copy does no harm), and
    bounds the rows of a batch."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if sc.applicationId not in _SHIPPED:
        package = Path(telemetra.__file__).parent
        path = Path(tempfile.mkdtemp(prefix="telemetra-"), "telemetra_tasks.zip")  # on the driver; Spark hands it out from here
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(path))
        _SHIPPED.add(sc.applicationId)


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
