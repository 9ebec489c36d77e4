"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once an application.

    Workers import it by name, so what they keep between tasks stays; where it
    is installed already nothing changes.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints.

    ``spark.checkpoint.dir`` names the folder that all executors share.  Only
    where it is unset in a local session (tests) a temporary folder is made; on
    a cluster a folder of one machine would lose data, so that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="corpuskiln-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint; what is cut already isn't written again."""
    if getattr(df, "_is_cut", False):
        return df
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    out._is_cut = True
    return out


def local_session(cpus: int = 8, app: str = "corpuskiln", **conf: str) -> SparkSession:
    """A ``local[cpus]`` session with the settings the library is tuned for."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
