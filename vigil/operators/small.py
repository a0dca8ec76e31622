"""Tables that are small as a rule: written once, and broadcast only if their counted size allows it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

#: Rows (of a few short columns) up to which a table is broadcast; beyond, joins with it shuffle.
BROADCAST_ROWS = 200_000


def small_table(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/small-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return F.broadcast(back) if back.count() <= BROADCAST_ROWS else back
