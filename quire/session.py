"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Batches to Python by size, not by number of rows: long texts then need no more memory than short ones.
ARROW_BYTES = 2 << 20


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings below, which are safe at any scale. Master,
    shuffle partitions and driver memory are the cluster's to say: they are set
    only where the caller passes them (bench and tests do)."""
    spark = SparkSession.builder.config(map=options(master, app, shuffle_partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def options(master: str | None = None, app: str = "quire", shuffle_partitions: int | None = None) -> dict[str, str]:
    """The settings that ``build_session`` makes."""
    out = {
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # delete reliable checkpoint files once their DataFrames are gone
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if master:
        out["spark.master"] = master
    if shuffle_partitions:
        out["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if os.environ.get("QUIRE_DRIVER_MEMORY"):
        out["spark.driver.memory"] = os.environ["QUIRE_DRIVER_MEMORY"]
    return out


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every query relies on: UTC session time, a checkpoint dir,
    and this package shipped to the executors' Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(_ARROW_BYTES, str(ARROW_BYTES))
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Zip the ``quire`` package once per SparkContext and add it with
    ``addPyFile`` so pandas functions defined here unpickle on executors."""
    import shutil
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="quire-pkg-")
    archive = shutil.make_archive(os.path.join(out, "quire"), "zip", os.path.dirname(pkg), "quire")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent *and* the master is local (tests, bench)
    do we create a scratch folder of our own; on a cluster an unset value is
    an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    value = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not value:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        value = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, value)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(value)
    return value


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): the result survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out anew if it comes in fewer partitions than there are cores, as a few files that
    cannot be split do; a table of many files stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
