"""Shared helpers: inputs, the shared scratch folder, Arrow maps, components."""

from __future__ import annotations

import os
import re
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
BROADCAST_IDS = 2_000_000      # ids sent to all tasks, at most (16 MB)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet``, only the named columns, dealt
    over so many partitions as the explicit setting ``colloquy.read.rebalance``
    names (for text tables in a few unsplittable files), else as scanned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    parts = int(spark.conf.get("colloquy.read.rebalance", "0"))
    return df.repartition(parts) if parts > 0 and name in ("documents", "pages") else df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``), as the session
    names it, scheme included.  Only a local session (one machine, as in tests)
    gets a folder of its own where the setting is missing."""
    sc = spark.sparkContext
    named = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"{CHECKPOINT_CONF} is not set: it must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="colloquy-llm-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared folder and read it
    back: cuts the lineage, survives lost executors, gives exact sizes."""
    path = f"{shared_dir(df.sparkSession)}/colloquy-llm/{name}-{os.urandom(8).hex()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``df`` whose ``keys`` (doc_id) are not in ``ids`` (a null key
    matches a null id).  The ids are settled and counted: up to
    ``BROADCAST_IDS`` they are sent to the rows, which then stay where they
    are; more are joined by shuffle."""
    keys = keys or ("doc_id",)
    named = settle(ids.select(*[F.col(k).alias("_gone_" + k) for k in keys]), "ids")
    named = F.broadcast(named) if named.count() <= BROADCAST_IDS else named
    same = [df[k].eqNullSafe(named["_gone_" + k]) for k in keys]
    return df.join(named, same, "left_anti")


def map_arrow(df: DataFrame, step, schema: str) -> DataFrame:
    """``df`` through ``step(batch) -> dict of columns`` (or None), batch by
    batch, inside the partitions that Spark made."""
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        for batch in batches:
            out = step(batch)
            if out is not None:
                yield to_batch(out, target)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def ddl(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        col = columns[field.name]
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        if not isinstance(col, pa.Array):
            col = pa.array(col, type=field.type)
        arrays.append(col.cast(field.type) if col.type != field.type else col)
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the links ``u, v`` (longs): ``node, root`` for
    every node that has a link, root = smallest node of its component.

    Alternating large-star / small-star rounds: every node points its larger
    neighbours, then its smaller ones, at the smallest neighbour.  Each round
    is a partial aggregate and an equi-join on the node (a hot centre is split
    by the skew join), written to the shared folder.  Ends when a round
    changes nothing; raises if that never happens."""
    cur = settle(edges.filter("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        mark = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return cur.selectExpr("u AS node", "v AS root").union(
                cur.selectExpr("v AS node", "v AS root").distinct())
        seen = tuple(mark)
        both = cur.union(cur.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        cur = settle(small.filter("v <> m").selectExpr("v AS u", "m AS v")
                     .union(low.selectExpr("u", "m AS v")).distinct(), "links")
    raise RuntimeError("connected components did not settle")
