"""Session helpers: table access, shared folders and shipping this package to executors."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table of that name, a Parquet file or folder below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only in local mode, where it may be unset, one is made.

    On a cluster a folder of the driver's machine would be lost to the executors, so that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakeloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root


#: Stages that this process has written, by session.
_STAGES: dict[int, list[str]] = {}


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The files are in a folder all executors share, so a lost executor costs nothing. They stay
    until :func:`drop_stages`, as results that are not yet computed read them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGES.setdefault(id(spark.sparkContext), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> int:
    """Delete the stages written so far, once the results that read them are computed; their number."""
    paths = _STAGES.pop(id(spark.sparkContext), [])
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors where PYTHONPATH does not."""
    root = str(_PACKAGE.parent)
    paths = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    sc = spark.sparkContext
    if root in paths or getattr(sc, "_lakeloom_shipped", False):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, str(p.relative_to(_PACKAGE.parent)))
    place = Path(tempfile.mkdtemp(prefix="lakeloom-")) / "lakeloom.zip"
    place.write_bytes(buffer.getvalue())
    sc.addPyFile(str(place))  # the driver serves it to every executor, present and future
    sc._lakeloom_shipped = True
