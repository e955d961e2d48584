"""Session-level helpers. The caller always supplies the session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies in ``spark.checkpoint.dir`` or, where the session names none, in
    its warehouse: both are shared whatever the master is.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_stages"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def layout_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
