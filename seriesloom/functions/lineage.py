"""Materialise a plan that several branches read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def _set_checkpoint_dir(sc) -> None:
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="seriesloom-checkpoint-")
        sc.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpointed copy in the folder the session names in spark.checkpoint.dir.

    Checkpoint files survive a lost executor. Only a local session without that setting (tests)
    gets a temporary folder; a cluster without it is told to set one.
    """
    _set_checkpoint_dir(df.sparkSession.sparkContext)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Copy as Parquet files in the same folder, for wide tables whose readers take few columns each."""
    sc = df.sparkSession.sparkContext
    _set_checkpoint_dir(sc)
    path = f"{sc.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
