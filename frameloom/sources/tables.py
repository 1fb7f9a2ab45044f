"""Clips that are views of relational tables: how the driver's tables become
frames. Each gives SCANLINES of its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import Clip


def gray8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 gray frames, one for each row of ``embeddings``. A row is a
    frame, so its lines are cut without a shuffle."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    values = "transform(embedding, e -> cast(least(255D, greatest(0D, floor((cast(e as double) + 1) * 127.5D))) as int))"
    rows = rows.select(F.lit("gray8").alias("clip_id"), F.col("vec_id").cast("long").alias("frame_no"), F.expr(values).alias("p"))
    return rows.select("clip_id", "frame_no", F.posexplode(F.expr("transform(sequence(0, 7), y -> array(slice(p, y * 8 + 1, 8)))")).alias("y", "planes"))


def _whole(rows: DataFrame, key: str, size: int, values: list[str]) -> DataFrame:
    """(frame_no, p): for each frame that has any row, ``size`` structs of the
    values in order of the key, 0 where there is no row."""
    own = F.struct((F.col(key) % size).cast("int").alias("i"), *(F.expr(v) for v in values))
    held = rows.groupBy(F.expr(f"{key} div {size}").alias("frame_no")).agg(F.collect_list(own).alias("held"))
    names = [v.rsplit(" as ", 1)[1] for v in values]
    blank = F.expr(f"transform(sequence(0, {size - 1}), i -> struct(i as i, {', '.join(f'0 as {n}' for n in names)}))")
    missing = F.expr("filter(blank, b -> not array_contains(seen, b.i))")
    held = held.withColumns({"blank": blank, "seen": F.expr("transform(held, h -> h.i)")})
    return held.select("frame_no", F.when(F.size("held") == size, F.sort_array("held")).otherwise(F.sort_array(F.concat("held", missing))).alias("p"))


def rgb8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 color frames, one for each 64 numbers of ``events``; what is
    missing is black."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value", "user_id")
    frames = _whole(events, "event_id", 64, ["cast(floor(value) % 256 as int) as r", "cast(floor(value * 7) % 256 as int) as g", "cast(user_id % 256 as int) as b"])
    lines = frames.select("frame_no", F.posexplode(F.expr("transform(sequence(0, 7), y -> slice(p, y * 8 + 1, 8))")).alias("y", "p"))
    return lines.select(F.lit("rgb8").alias("clip_id"), "frame_no", "y", F.expr("array(p.r, p.g, p.b)").alias("planes"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1024 x 1 gray frames, one for each 1024 numbers of ``orders``; what is
    missing is black."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    frames = _whole(orders, "o_orderkey", 1024, ["cast(floor(o_totalprice) % 256 as int) as v"])
    return frames.select(F.lit("wide").alias("clip_id"), "frame_no", F.lit(0).alias("y"), F.expr("array(p.v)").alias("planes"))


def clip(spark: SparkSession, sf_dir: str, name: str) -> Clip:
    """One of the views with its metadata."""
    view, table, key, each, size, mode = {"gray8": (gray8, "embeddings", "vec_id", 1, (8, 8), "GRAY"), "rgb8": (rgb8, "events", "event_id", 64, (8, 8), "RGB"), "wide": (wide, "orders", "o_orderkey", 1024, (1024, 1), "GRAY")}[name]
    last = spark.read.parquet(f"{sf_dir}/{table}.parquet").agg(F.max(key)).first()[0]
    return Clip(view(spark, sf_dir), name, 30.0, *size, mode, 0 if last is None else last // each + 1, source={"table": table})
