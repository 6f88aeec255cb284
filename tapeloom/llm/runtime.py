"""What the operators of this package share: shipping code and files, Arrow maps, stored tables."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom.session import scratch_path

#: Vocabulary files are sent to the executors whole, so their size is checked.
MAX_FILE_BYTES = 64 << 20

_SHIPPED: set[str] = set()
_FILES: dict[tuple[str, str], object] = {}


def ship(spark: SparkSession) -> None:
    """Send this library's source files to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    target = os.path.join(tempfile.mkdtemp(prefix="tapeloom-code-"), f"tapeloom-{uuid.uuid4().hex}.zip")
    Path(target).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(target)  # read at once by the driver and served to the executors
    _SHIPPED.add(app)


def shared_file(spark: SparkSession, path: str):
    """A broadcast of the bytes of a file that the driver can open; at most ``MAX_FILE_BYTES``."""
    known = (spark.sparkContext.applicationId, path)
    if known not in _FILES:
        if (size := os.path.getsize(path)) > MAX_FILE_BYTES:
            raise ValueError(f"{path} has {size} bytes, more than {MAX_FILE_BYTES}")
        _FILES[known] = spark.sparkContext.broadcast(Path(path).read_bytes())
    return _FILES[known]


def arrow_map(
    df: DataFrame,
    batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``df`` through a function over its Arrow batches, with this library on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(batches, schema)


def quoted(name: str) -> str:
    """A column name as ``F.col`` takes it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def packed(columns: list[str]) -> Column:
    """Columns as one struct, so that their names meet no others."""
    return F.struct(*map(quoted, columns)) if columns else F.lit(0)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: later plans start from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Stored tables of a few numbers a row are broadcast up to this many rows.
BROADCAST_ROWS = 500_000


def sized(small: DataFrame, rows: int | None = None) -> DataFrame:
    """``small`` (stored, narrow) for the small side of a join: broadcast if it is counted to have
    few rows, and left to a shuffle beyond that."""
    return F.broadcast(small) if (small.count() if rows is None else rows) <= BROADCAST_ROWS else small


def met(rows: DataFrame, keyed: DataFrame, on: list[str], weight: Column, hot: int) -> DataFrame:
    """An inner join of many rows to a stored table with one row per key, where a key may own most of the rows.

    Few keys go to all rows; of many keys only those do whose ``weight`` (about their number of rows) reaches
    ``hot``, which there can only be few of, and the others meet by a shuffle.
    """
    if keyed.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keyed), on)
    heavy = sized(keyed.where(weight >= hot))
    others = rows.join(heavy.select(*on), on, "left_anti").join(keyed.where(weight < hot), on)
    apart = rows.join(heavy, on)
    return apart.unionByName(others.select(*apart.columns))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
