"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only where that is unset and Spark runs in one process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="stagewise-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python tasks can import it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        import stagewise
        root = Path(stagewise.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="stagewise-code-")) / "stagewise_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in root.rglob("*.py"):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(batches: Iterator[pa.RecordBatch], col: str, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches cut and gathered so that their ``col`` holds about ``most`` bytes; bounds what a task keeps at once."""
    held, size = [], 0
    for whole in batches:
        i = whole.schema.get_field_index(col)
        step = max(1, whole.num_rows * most // max(1, whole.column(i).nbytes))
        for b in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
            held.append(b)
            size += b.column(i).nbytes
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [b"" if x is None else x for x in col.cast(pa.binary()).to_pylist()]


def plus(schema: T.StructType, ddl: str) -> T.StructType:
    """A schema with the fields of ``ddl`` behind its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def crc_mod(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def attach(left: DataFrame, right: DataFrame, key: str, count: str, total: int, keep: list[str]) -> DataFrame:
    """Left join with one row per key on the right, safe for keys with a third of all rows.

    ``right[count]`` is the number of left rows of the key and ``total`` that of
    all left rows.  Keys with over 1/256 of the rows are 256 at most, so their
    rows are broadcast; the others join by shuffle.
    """
    few = right.where((F.col(count) > 1000) & (F.col(count) > total / 256)).select(key, *keep, F.lit(True).alias("_hot"))
    first = left.join(F.broadcast(few), key, "left")
    hot = first.where("_hot").drop("_hot")
    cold = first.where(F.col("_hot").isNull()).drop("_hot", *keep)
    rest = right.where((F.col(count) <= 1000) | (F.col(count) <= total / 256)).select(key, *keep)
    return hot.select(*left.columns, *keep).unionByName(cold.join(rest, key, "left").select(*left.columns, *keep))
