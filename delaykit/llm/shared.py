"""Tables in the folder that all machines of the cluster share, and null-safe ids."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset a folder of this machine serves in local mode, as in tests;
    on a cluster that is an error, since executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        folder = "file://" + tempfile.mkdtemp(prefix="delaykit-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


@lru_cache(maxsize=1)
def _archive() -> str:
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="delaykit-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    return str(path)


def send_code(spark: SparkSession) -> None:
    """Lets the executors' Python import this package; Spark sends the file to each."""
    spark.sparkContext.addPyFile(_archive())


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; runs never write over each other."""
    return f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs no work done before this point.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(text) -> str:
    """A text for a UDF: null counts as empty."""
    return text if isinstance(text, str) else ""


def held_out(id_col) -> F.Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
