"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the engine's defaults; on a cluster the submitted configuration wins."""
    b = SparkSession.builder.appName("crateflow")
    if "SPARK_REMOTE" not in os.environ and not os.environ.get("SPARK_MASTER"):
        b = b.master(f"local[{cpus}]")
    return b.config(map=DEFAULTS | conf).getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the reliable checkpoint folder and return the copy that reads it back.

    The folder is the one named by ``spark.checkpoint.dir``. Where that is unset a temporary folder is made on a local master; on a
    cluster that is an error, as its executors share no local folder. Executors may be lost afterwards: the files are shared.
    Files of copies that are no longer referred to are removed where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir", "") and sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="crateflow-"))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """The rows over as many partitions as shuffles have, by the columns or evenly. For narrow rows that are costly to work on, which
    adaptive execution would put into few tasks by their size. The columns go in as a hash: rows that have just been shuffled by them
    would otherwise count as spread already, and then be put together."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*columns)) if columns else df.repartition(n)
