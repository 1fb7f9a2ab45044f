"""The engine's queries and their SQL twins, by name.

Integers come out as long and doubles rounded, so that both engines agree on
types; every query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import lanczos, pixel
from .operators import delta, display, modes, onebit, reframe, resize
from .plans import chain
from .schema import binary_violations, to_pixels
from .sources import frames, tables

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ("frame_no", "y", "x")


def _pixels(lines: DataFrame, *, c: bool = False, digits: int | None = None) -> DataFrame:
    v = F.col("v").cast("long") if digits is None else F.round(F.col("v").cast("double"), digits)
    return to_pixels(lines).select(*(F.col(k).cast("long").alias(k) for k in (*KEYS, *(["c"] if c else []))), v.alias("v"))


def _longs(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*(F.col(n).cast("long").alias(n) for n in names))


def _on(view: Callable[[SparkSession, str], DataFrame], *steps, **how) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = view(spark, sf_dir)
        for step in steps:
            lines = step(lines)
        return _pixels(lines, **how)

    return run


def _changed(lines: DataFrame) -> DataFrame:
    """Changed pixels of each frame."""
    coded = delta.delta_encode(onebit.threshold(lines, 128))
    n = F.aggregate(F.flatten("planes"), F.lit(0).cast("long"), lambda s, v: s + v)
    return _longs(coded.groupBy("frame_no").agg(F.sum(n).alias("changed")), "frame_no", "changed")


def _clip_u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.expr(pixel.clamp("value * 3 - 50", "uint8"))
    return _longs(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", v.alias("v")), "event_id", "v")


def _timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("frame_no"))
    return rows.select("frame_no", F.round(F.col("frame_no") / 30.0, 6).alias("ts"))


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(o, i, w) for o, taps in enumerate(lanczos.weights(8, 5)) for i, w in taps]
    return spark.createDataFrame(rows, "o long, i long, w double").withColumn("w", F.round("w", 6))


def _metric(f: Callable[[DataFrame], DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: f(tables.gray8(spark, sf_dir)).select("frame_no", *(F.round(n, 6).alias(n) for n in names))


def _simple(fps: float) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        clip = tables.clip(spark, sf_dir, "gray8")
        kept = reframe.simple(clip.scanlines.filter("y = 0"), clip.frame_count, clip.fps, fps)
        return _longs(kept, "out_no", "frame_no")

    return run


def _intelligent(fps: float) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        clip = tables.clip(spark, sf_dir, "gray8")
        return _longs(reframe.best_frames(reframe.frame_scores(clip.scanlines), clip.frame_count, clip.fps, fps), "out_no", "frame_no")

    return run


def _reframe_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reframe.reframe(tables.clip(spark, sf_dir, "gray8"), 10.0, "simple").stats["reframe"]
    row = spark.createDataFrame([(found["original_frame_count"], found["output_frame_count"], found["compression_ratio"], found["frame_drop_percentage"])], "original_frame_count long, output_frame_count long, compression_ratio double, frame_drop_percentage double")
    return row.withColumns({c: F.round(c, 6) for c in ("compression_ratio", "frame_drop_percentage")})


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = onebit.threshold(onebit.to_gray(tables.rgb8(spark, sf_dir)), 60)
    return onebit.pixel_stats(bits).withColumn("white_percentage", F.round("white_percentage", 6))


def _validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = onebit.threshold(tables.gray8(spark, sf_dir), 128).transform(binary_violations).withColumn("data", F.lit("bits"))
    raw = tables.gray8(spark, sf_dir).transform(binary_violations).withColumn("data", F.lit("gray"))
    return good.unionByName(raw)


def _runs(runs: DataFrame) -> DataFrame:
    return _longs(runs.select("frame_no", *(["y"] if "y" in runs.columns else []), F.posexplode("runs").alias("k", "r")).select("*", "r.n", "r.v"), "frame_no", *(["y"] if "y" in runs.columns else []), "k", "n", "v")


def _wide_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.threshold(tables.wide(spark, sf_dir), 0)


def _memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(c.clip_id, *(c.memory()[k] for k in ("frame_size_bytes", "total_bytes", "total_mb", "frame_count"))) for c in (tables.clip(spark, sf_dir, n) for n in ("gray8", "rgb8", "wide"))]
    return spark.createDataFrame(rows, "clip_id string, frame_size_bytes long, total_bytes long, total_mb double, frame_count long").withColumn("total_mb", F.round("total_mb", 6))


def _reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("clip_id"), F.expr("unix_micros(cast(ts as timestamp))").alias("shown_us"), F.col("event_id").alias("frame_no"))
    return display.reached_rate(shown).select("frame_no", F.round("rate", 6).alias("rate"))


def _gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All frames in reversed order, each twice."""
    clip = tables.clip(spark, sf_dir, "gray8")
    last = clip.frame_count - 1
    picked = clip.scanlines.filter("y = 0").select(F.explode(F.expr(f"array(2L * ({last}L - frame_no), 2L * ({last}L - frame_no) + 1)")).alias("out_no"), "frame_no")
    rows = display.gather(clip.scanlines, picked).select("clip_id", F.col("out_no").alias("frame_no"), "y", "planes")
    return _pixels(rows)


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-bit frames whose numbers have gaps of every length up to 9 and
    beyond chunks and key frames: each frame at its number's square."""
    bits = _bits(tables.gray8(spark, sf_dir))
    return bits.withColumn("frame_no", F.expr("frame_no * frame_no div 7 + frame_no"))


def _gaps_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded and decoded, without key frames and with them."""
    lines = _gappy(spark, sf_dir)
    plain = delta.delta_decode(delta.delta_encode(lines))
    keyed = delta.delta_decode(delta.delta_encode(lines, key_every=40), key_every=40)
    both = plain.join(keyed.withColumnRenamed("planes", "keyed"), ["clip_id", "frame_no", "y"])
    return _pixels(both.select("clip_id", "frame_no", "y", F.expr("if(planes = keyed, planes, null)").alias("planes")))


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded with key frames, written, read and decoded."""
    path = frames.scratch_folder(spark)
    frames.write_clip(chain.Chain().then(chain.one_bit(128)).then(chain.delta_coding(50)).run(tables.clip(spark, sf_dir, "gray8")), path)
    return _pixels(delta.delta_decode_clip(frames.read_clip(spark, path)).scanlines)


def _clipped(dtype: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = F.expr(pixel.clamp("(value - 40D) * 900.7D", dtype))
        v = v.cast("long") if dtype.startswith("u") else F.round(v, 6)
        return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").cast("long").alias("event_id"), v.alias("v"))

    return run


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    clip = chain.Chain().then(chain.resizing(5, 6)).then(chain.reframing(12.0, "simple")).then(chain.one_bit(60)).run(tables.clip(spark, sf_dir, "rgb8"))
    return chain.summary(clip).select(F.col("step").cast("long").alias("step"), "component")


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(c.clip_id, c.batch_size(), c.batch_size(50, single_mb=0, batch_mb=0.01)) for c in (tables.clip(spark, sf_dir, n) for n in ("gray8", "rgb8", "wide"))]
    return spark.createDataFrame(rows, "clip_id string, whole long, batch long")


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    clip = tables.clip(spark, sf_dir, "rgb8")
    clip = onebit.to_1bit(reframe.reframe(resize.resize(clip, (5, 6)), 12.0, "simple"), 60, "ordered", "bayer4x4")
    return _pixels(delta.delta_encode_clip(clip, check=False).scanlines)


def _bits(lines: DataFrame) -> DataFrame:
    return onebit.threshold(lines, 128)


def queries() -> dict[str, Query]:
    g, rgb = tables.gray8, tables.rgb8
    dither = lambda p: _on(g, lambda x: onebit.ordered_dither(x, 128, p))
    return {
        "delta_changed": lambda spark, d: _changed(tables.gray8(spark, d)),
        "gray_frames": _on(g),
        "rgb_to_gray": _on(rgb, onebit.to_gray),
        "channel_split": _on(rgb, onebit.channel),
        "channel_replicate": _on(g, onebit.replicate, c=True),
        "frame_timestamps": _timestamps,
        "dtype_clip_u8": _clip_u8,
        "threshold_128": _on(g, _bits),
        "threshold_60": _on(rgb, onebit.to_gray, lambda x: onebit.threshold(x, 60)),
        "bayer2x2": dither("bayer2x2"),
        "bayer4x4": dither("bayer4x4"),
        "bayer8x8": dither("bayer8x8"),
        "bayer8x8_rgb": _on(rgb, onebit.to_gray, lambda x: onebit.ordered_dither(x, 60, "bayer8x8")),
        "noise_dither": _on(g, lambda x: onebit.noise_dither(x, 128)),
        "floyd_steinberg": _on(g, lambda x: onebit.floyd_steinberg(x, 128)),
        "onebit_stats": _stats,
        "validate_binary": _validate,
        "lanczos_weights": _weights,
        "lanczos_h": _on(g, lambda x: resize.horizontal(x, 8, 5), digits=3),
        "lanczos_v": _on(g, lambda x: resize.vertical(x, 8, 11), digits=3),
        "lanczos_2d": _on(g, lambda x: resize.lanczos_resize(x, (8, 8), (5, 11))),
        "lanczos_2d_arrow": _on(g, lambda x: resize.lanczos_resize_arrow(x, (8, 8), (5, 11))),
        "lanczos_rgb": _on(rgb, lambda x: resize.lanczos_resize(x, (8, 8), (12, 4)), c=True),
        "frame_variance": _metric(reframe.frame_variance, "variance"),
        "frame_difference": _metric(reframe.frame_difference, "difference"),
        "frame_scores": _metric(reframe.frame_scores, "variance", "difference", "score"),
        "reframe_simple_10": _simple(10.0),
        "reframe_simple_12": _simple(12.0),
        "reframe_simple_24": _simple(24.0),
        "reframe_intelligent_10": _intelligent(10.0),
        "reframe_intelligent_12": _intelligent(12.0),
        "reframe_stats": _reframe_stats,
        "delta_pixels": _on(g, _bits, delta.delta_encode),
        "delta_keyframes": _on(g, _bits, lambda x: delta.delta_encode(x, key_every=50)),
        "delta_decode_roundtrip": _on(g, _bits, lambda x: delta.delta_encode(x, key_every=50), lambda x: delta.delta_decode(x, key_every=50)),
        "rle_rows": lambda spark, d: _runs(delta.rle_rows(_bits(tables.gray8(spark, d)))),
        "rle_wide_cap255": lambda spark, d: _runs(delta.rle_rows(_wide_bits(spark, d))),
        "rle_frame_uncapped": lambda spark, d: _runs(delta.rle_frames(_bits(tables.gray8(spark, d)))),
        "rle_decode_roundtrip": lambda spark, d: _pixels(delta.rle_decode(delta.rle_rows(_wide_bits(spark, d)))),
        "rle_row_sizes": lambda spark, d: _longs(delta.rle_sizes(delta.rle_rows(_wide_bits(spark, d))), "max_row_size"),
        "max_frames_limit": lambda spark, d: _pixels(tables.gray8(spark, d).filter("frame_no < 10")),
        "memory_estimate": _memory,
        "batch_sizes": _batches,
        "display_values": lambda spark, d: _pixels(display.normalise(tables.clip(spark, d, "rgb8")), c=True, digits=6),
        "frame_captions": lambda spark, d: display.captions(tables.clip(spark, d, "gray8")),
        "reached_rate": _reached,
        "frame_gather": _gathered,
        "delta_gaps": lambda spark, d: _pixels(delta.delta_encode(_gappy(spark, d), key_every=40)),
        "delta_gaps_decoded": _gaps_decoded,
        "delta_written_roundtrip": _written,
        "delta_decode_no_keys": _on(g, _bits, delta.delta_encode, delta.delta_decode),
        "dtype_clip_u16": _clipped("uint16"),
        "dtype_float": _clipped("float64"),
        "processing_summary": _summary,
        "pipeline_full": _pipeline,
        "scanline_mode": _on(g, _bits, modes.scanline_mode),
        "interlaced_mode": _on(g, _bits, modes.interlaced_mode),
    }


# SQL twins. Literals with an exponent are doubles; floor before casts, which round in DuckDB.
_VIEWS = {
    "gray8": """gray8 AS (SELECT vec_id AS frame_no, (p - 1) // 8 AS y, (p - 1) % 8 AS x,
        CAST(least(255e0, greatest(0e0, floor((CAST(embedding[p] AS DOUBLE) + 1e0) * 127.5e0))) AS BIGINT) AS v
        FROM embeddings, generate_series(1, 64) AS g(p))""",
    "rgb8": """rgb8 AS (SELECT f AS frame_no, p // 8 AS y, p % 8 AS x,
        coalesce(CAST(floor(value) AS BIGINT) % 256, 0) AS r, coalesce(CAST(floor(value * 7e0) AS BIGINT) % 256, 0) AS g, coalesce(user_id % 256, 0) AS b
        FROM (SELECT DISTINCT event_id // 64 AS f FROM events) CROSS JOIN generate_series(0, 63) AS s(p) LEFT JOIN events ON event_id = f * 64 + p)""",
    "wide": """wide AS (SELECT f AS frame_no, 0 AS y, p AS x, coalesce(CAST(floor(o_totalprice) AS BIGINT) % 256, 0) AS v
        FROM (SELECT DISTINCT o_orderkey // 1024 AS f FROM orders) CROSS JOIN generate_series(0, 1023) AS s(p) LEFT JOIN orders ON o_orderkey = f * 1024 + p)""",
    "luma": """luma AS (SELECT frame_no, y, x, CAST(floor(least(255e0, greatest(0e0, 0.299e0 * r + 0.587e0 * g + 0.114e0 * b))) AS BIGINT) AS v FROM rgb8)""",
    "bits": "bits AS (SELECT frame_no, y, x, CASE WHEN v > 128 THEN 1 ELSE 0 END AS v FROM gray8)",
    "gappy": "gappy AS (SELECT frame_no * frame_no // 7 + frame_no AS frame_no, y, x, v FROM bits)",
    "wbits": "wbits AS (SELECT frame_no, y, x, CASE WHEN v > 0 THEN 1 ELSE 0 END AS v FROM wide)",
}


def _sql(select: str, *views: str) -> str:
    return ("WITH " + ", ".join(_VIEWS.get(v, v) for v in views) + " " if views else "") + select


def _all(source: str, value: str = "v", extra: str = "") -> str:
    return f"SELECT CAST(frame_no AS BIGINT) AS frame_no, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x{extra}, CAST({value} AS BIGINT) AS v FROM {source}"


def _dither_sql(source: str, pattern: str, t: int) -> str:
    rows = pixel.BAYER[pattern]
    n = len(rows)
    cells = ", ".join(f"({y}, {x}, {v / n**2!r}e0)" for y, row in enumerate(rows) for x, v in enumerate(row))
    return _all(f"{source} JOIN (VALUES {cells}) AS m(my, mx, m) ON y % {n} = my AND x % {n} = mx", f"CASE WHEN v > {t}e0 + (m - 0.5e0) * 64e0 THEN 1 ELSE 0 END")


def _weights_sql(name: str, size: int, target: int) -> str:
    return f"""{name} AS (SELECT o, i, CAST(CAST(k AS DOUBLE) / sum(CAST(k AS DOUBLE)) OVER (PARTITION BY o) AS FLOAT) AS w FROM (
        SELECT o, i, CAST(CASE WHEN d = 0 THEN 1e0 WHEN abs(d) >= 4 THEN 0e0 ELSE 4e0 * sin(pi() * d) * sin(pi() * d / 4e0) / (pi() * pi() * d * d) END AS FLOAT) AS k
        FROM (SELECT o, i, pos - i AS d FROM (SELECT o, pos, CAST(trunc(pos) AS BIGINT) + s AS i FROM (
            SELECT o, (o + 0.5e0) * ({size}e0 / {target}e0) - 0.5e0 AS pos FROM generate_series(0, {target - 1}) AS a(o)), generate_series(-3, 4) AS b(s)))
        WHERE i BETWEEN 0 AND {size - 1}))"""


def _across(name: str, source: str, table: str, axis: str, rest: str) -> str:
    others = f"frame_no, {'y' if axis == 'x' else 'x'}{rest}"
    return f"{name} AS (SELECT {others}, o AS {axis}, CAST(sum(CAST(CAST(v AS FLOAT) * w AS DOUBLE) ORDER BY i) AS FLOAT) AS v FROM {source} JOIN {table} ON {axis} = i GROUP BY {others}, o)"


_U8 = "floor(least(255e0, greatest(0e0, CAST(v AS DOUBLE))))"
_VARIANCE = "fv AS (SELECT frame_no, CAST(count(*) * sum(v * v) - sum(v) * sum(v) AS DOUBLE) / CAST(count(*) * count(*) AS DOUBLE) AS variance FROM gray8 GROUP BY frame_no)"
_DIFFERENCE = "fd AS (SELECT frame_no, CAST(sum(d) AS DOUBLE) / count(*) AS difference FROM (SELECT frame_no, coalesce(abs(v - lag(v) OVER (PARTITION BY y, x ORDER BY frame_no)), 0) AS d FROM gray8) GROUP BY frame_no)"
_SCORES = """scores AS (SELECT frame_no, variance, difference,
    0.7e0 * (variance / CASE WHEN max(variance) OVER () > 0 THEN max(variance) OVER () ELSE 1e0 END) + 0.3e0 * (difference / CASE WHEN max(difference) OVER () > 0 THEN max(difference) OVER () ELSE 1e0 END) AS score
    FROM fv JOIN fd USING (frame_no))"""


def _slots(fps: float) -> str:
    r = f"(30e0 / {fps}e0)"
    return f"slots AS (SELECT w, CAST(floor(w * {r}) AS BIGINT) AS a, least(CAST(floor((w + 1) * {r}) AS BIGINT), n) AS b, n FROM (SELECT unnest(generate_series(0, CAST(floor(n / {r}) AS BIGINT) - 1)) AS w, n FROM (SELECT count(*) AS n FROM embeddings)))"


def _simple_sql(fps: float) -> str:
    return _sql("SELECT w AS out_no, least(a, n - 1) AS frame_no FROM slots", _slots(fps))


def _intelligent_sql(fps: float) -> str:
    return _sql("SELECT w AS out_no, arg_max(frame_no, (score, -frame_no)) AS frame_no FROM slots JOIN scores ON frame_no >= a AND frame_no < b GROUP BY w", "gray8", _VARIANCE, _DIFFERENCE, _SCORES, _slots(fps))


def _delta_sql(source: str, every: int | None = None) -> str:
    key = f" OR frame_no // {every} <> before_no // {every}" if every else ""
    return f"coded AS (SELECT frame_no, y, x, CASE WHEN before IS NULL{key} THEN v ELSE xor(v, before) END AS v FROM (SELECT *, lag(v) OVER w AS before, lag(frame_no) OVER w AS before_no FROM {source} WINDOW w AS (PARTITION BY y, x ORDER BY frame_no)))"


def _noise_sql(t: int, seed: int = 0, spread: int = 16) -> str:
    p = onebit.NOISE_PRIME
    line = f"CAST('0x' || substr(md5(concat_ws(':', {seed}, 'gray8', frame_no, y)), 1, 7) AS BIGINT)"
    h = f"(SELECT frame_no, y, x, v, ({line} * 8 + x * 40503) % {p} AS h FROM gray8)"
    for add in (12345, 777):
        h = f"(SELECT frame_no, y, x, v, (h * h + {add}) % {p} AS h FROM {h})"
    return _all(h, f"CASE WHEN least(255e0, greatest(0e0, v + (h / {p}e0 - 0.5e0) * {2 * spread})) > {t}e0 THEN 1 ELSE 0 END")


def _diffusion_sql(t: int) -> str:
    """Error diffusion of 8 x 8 frames, a pixel at each step."""
    shares = [("x < 7", 1, 7), ("x > 0", 7, 3), ("true", 8, 5), ("x < 7", 9, 1)]  # where, how far on, sixteenths
    cells = " ".join(f"WHEN i = k + 1 + {far} AND {where} THEN CAST(CAST(q AS DOUBLE) + error * {n}e0 / 16e0 AS FLOAT)" for where, far, n in shares)
    return f"""WITH RECURSIVE {_VIEWS['gray8']}, steps(frame_no, k, work, bits) AS (
        SELECT frame_no, CAST(0 AS BIGINT), list(CAST(v AS FLOAT) ORDER BY y, x), CAST([] AS BIGINT[]) FROM gray8 GROUP BY frame_no
        UNION ALL SELECT frame_no, k + 1, [CASE {cells} ELSE q END for q, i in work], list_append(bits, bit) FROM (
            SELECT *, old - CASE WHEN bit = 1 THEN 255e0 ELSE 0e0 END AS error FROM (
                SELECT *, k % 8 AS x, CAST(work[k + 1] AS DOUBLE) AS old, CASE WHEN CAST(work[k + 1] AS DOUBLE) > {t}e0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS bit FROM steps WHERE k < 64)))
        {_all("(SELECT frame_no, (p - 1) // 8 AS y, (p - 1) % 8 AS x, bits[p] AS v FROM (SELECT frame_no, bits, unnest(generate_series(1, 64)) AS p FROM steps WHERE k = 64))")}"""


def _runs_sql(source: str, line: str, at: str, cap: int | None) -> str:
    """Gaps and islands, with long runs cut."""
    part = f"PARTITION BY {line}"
    runs = f"""isl AS (SELECT {line}, v, {at} - row_number() OVER ({part}, v ORDER BY {at}) AS g, {at} AS p FROM {source}),
        runs AS (SELECT {line}, v, min(p) AS p, count(*) AS n FROM isl GROUP BY {line}, v, g)"""
    if cap:
        cut = f"SELECT {line}, v, p, j, least({cap}, n - {cap} * j) AS n FROM (SELECT *, unnest(generate_series(0, (n - 1) // {cap})) AS j FROM runs)"
    else:
        cut = f"SELECT {line}, v, p, 0 AS j, n FROM runs"
    return f"{runs}, cut AS ({cut}), coded AS (SELECT {line}, row_number() OVER ({part} ORDER BY p, j) - 1 AS k, n, v FROM cut)"


def oracle_sql() -> dict[str, str]:
    longs = lambda *names: ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)
    keys = {"embeddings": "vec_id", "events": "event_id", "orders": "o_orderkey"}
    memory = lambda name, size, each, table: f"SELECT '{name}' AS clip_id, CAST({size} AS BIGINT) AS frame_size_bytes, CAST({size} * n AS BIGINT) AS total_bytes, round({size} * n / 1048576e0, 6) AS total_mb, CAST(n AS BIGINT) AS frame_count FROM (SELECT max({keys[table]}) // {each} + 1 AS n FROM {table})"
    full = [_weights_sql("wx", 8, 5), _weights_sql("wy", 8, 6), "planes AS (SELECT frame_no, y, x, unnest([0, 1, 2]) AS c, unnest([r, g, b]) AS v FROM rgb8)", _across("h", "planes", "wx", "x", ", c"), _across("vv", "h", "wy", "y", ", c"), f"u8 AS (SELECT frame_no, y, x, c, {_U8} AS v FROM vv)"]
    cells = ", ".join(f"({y}, {x}, {v / 16!r}e0)" for y, row in enumerate(pixel.BAYER["bayer4x4"]) for x, v in enumerate(row))
    full += [
        "lum AS (SELECT frame_no, y, x, floor(least(255e0, greatest(0e0, 0.299e0 * max(v) FILTER (c = 0) + 0.587e0 * max(v) FILTER (c = 1) + 0.114e0 * max(v) FILTER (c = 2)))) AS v FROM u8 GROUP BY frame_no, y, x)",
        "slots AS (SELECT w, least(CAST(floor(w * (30e0 / 12e0)) AS BIGINT), n - 1) AS a FROM (SELECT unnest(generate_series(0, CAST(floor(n / (30e0 / 12e0)) AS BIGINT) - 1)) AS w, n FROM (SELECT max(event_id) // 64 + 1 AS n FROM events)))",
        f"b1 AS (SELECT w AS frame_no, y, x, CASE WHEN v > 60e0 + (m - 0.5e0) * 64e0 THEN 1 ELSE 0 END AS v FROM lum JOIN slots ON a = frame_no JOIN (VALUES {cells}) AS q(my, mx, m) ON y % 4 = my AND x % 4 = mx)",
        _delta_sql("b1"),
    ]
    twice = "SELECT frame_no, y, x, coalesce({own}, v) AS v FROM bits"
    found = {
        "delta_changed": _sql("SELECT CAST(frame_no AS BIGINT) AS frame_no, CAST(sum(v) AS BIGINT) AS changed FROM coded GROUP BY frame_no", "gray8", "bits", _delta_sql("bits")),
        "gray_frames": _sql(_all("gray8"), "gray8"),
        "rgb_to_gray": _sql(_all("luma"), "rgb8", "luma"),
        "channel_split": _sql(_all("rgb8", "r"), "rgb8"),
        "channel_replicate": _sql(_all("gray8, generate_series(0, 2) AS k(c)", extra=", CAST(c AS BIGINT) AS c"), "gray8"),
        "frame_timestamps": "SELECT CAST(vec_id AS BIGINT) AS frame_no, round(vec_id / 30e0, 6) AS ts FROM embeddings",
        "dtype_clip_u8": "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(floor(least(255e0, greatest(0e0, value * 3e0 - 50e0))) AS BIGINT) AS v FROM events",
        "threshold_128": _sql(_all("bits"), "gray8", "bits"),
        "threshold_60": _sql(_all("luma", "CASE WHEN v > 60 THEN 1 ELSE 0 END"), "rgb8", "luma"),
        **{p: _sql(_dither_sql("gray8", p, 128), "gray8") for p in pixel.BAYER},
        "bayer8x8_rgb": _sql(_dither_sql("luma", "bayer8x8", 60), "rgb8", "luma"),
        "onebit_stats": _sql("SELECT CAST(count(*) AS BIGINT) AS total_pixels, CAST(sum(b) AS BIGINT) AS white_pixels, CAST(count(*) - sum(b) AS BIGINT) AS black_pixels, round(sum(b) * 100e0 / count(*), 6) AS white_percentage FROM (SELECT CASE WHEN v > 60 THEN 1 ELSE 0 END AS b FROM luma)", "rgb8", "luma"),
        "validate_binary": _sql("SELECT 'bits' AS data, count(*) AS n_values, count(*) FILTER (v NOT IN (0, 1)) AS n_bad FROM bits UNION ALL SELECT 'gray', count(*), count(*) FILTER (v NOT IN (0, 1)) FROM gray8", "gray8", "bits"),
        "lanczos_weights": _sql("SELECT o, i, round(CAST(w AS DOUBLE), 6) AS w FROM wx", _weights_sql("wx", 8, 5)),
        "lanczos_h": _sql("SELECT frame_no, y, x, round(CAST(v AS DOUBLE), 3) AS v FROM h", "gray8", _weights_sql("wx", 8, 5), _across("h", "gray8", "wx", "x", "")),
        "lanczos_v": _sql("SELECT frame_no, y, x, round(CAST(v AS DOUBLE), 3) AS v FROM h", "gray8", _weights_sql("wy", 8, 11), _across("h", "gray8", "wy", "y", "")),
        "lanczos_rgb": _sql(_all("vv", _U8, ", CAST(c AS BIGINT) AS c"), "rgb8", "planes AS (SELECT frame_no, y, x, unnest([0, 1, 2]) AS c, unnest([r, g, b]) AS v FROM rgb8)", _weights_sql("wx", 8, 12), _weights_sql("wy", 8, 4), _across("h", "planes", "wx", "x", ", c"), _across("vv", "h", "wy", "y", ", c")),
        "frame_variance": _sql("SELECT frame_no, round(variance, 6) AS variance FROM fv", "gray8", _VARIANCE),
        "frame_difference": _sql("SELECT frame_no, round(difference, 6) AS difference FROM fd", "gray8", _DIFFERENCE),
        "frame_scores": _sql("SELECT frame_no, round(variance, 6) AS variance, round(difference, 6) AS difference, round(score, 6) AS score FROM scores", "gray8", _VARIANCE, _DIFFERENCE, _SCORES),
        "reframe_simple_10": _simple_sql(10),
        "reframe_simple_12": _simple_sql(12),
        "reframe_simple_24": _simple_sql(24),
        "reframe_intelligent_10": _intelligent_sql(10),
        "reframe_intelligent_12": _intelligent_sql(12),
        "reframe_stats": "SELECT n AS original_frame_count, m AS output_frame_count, round(m / CAST(n AS DOUBLE), 6) AS compression_ratio, round((1e0 - m / CAST(n AS DOUBLE)) * 100e0, 6) AS frame_drop_percentage FROM (SELECT n, CAST(floor(n / 3e0) AS BIGINT) AS m FROM (SELECT count(*) AS n FROM embeddings))",
        "delta_pixels": _sql(_all("coded"), "gray8", "bits", _delta_sql("bits")),
        "delta_keyframes": _sql(_all("coded"), "gray8", "bits", _delta_sql("bits", 50)),
        "delta_decode_roundtrip": _sql(_all("(SELECT frame_no, y, x, bit_xor(v) OVER (PARTITION BY y, x, frame_no // 50 ORDER BY frame_no ROWS UNBOUNDED PRECEDING) AS v FROM coded)"), "gray8", "bits", _delta_sql("bits", 50)),
        "rle_rows": _sql(f"SELECT {longs('frame_no', 'y', 'k', 'n', 'v')} FROM coded", "gray8", "bits", _runs_sql("bits", "frame_no, y", "x", 255)),
        "rle_wide_cap255": _sql(f"SELECT {longs('frame_no', 'y', 'k', 'n', 'v')} FROM coded", "wide", "wbits", _runs_sql("wbits", "frame_no, y", "x", 255)),
        "rle_frame_uncapped": _sql(f"SELECT {longs('frame_no', 'k', 'n', 'v')} FROM coded", "gray8", "bits", _runs_sql("bits", "frame_no", "(y * 8 + x)", None)),
        "rle_decode_roundtrip": _sql(_all("wbits"), "wide", "wbits"),
        "rle_row_sizes": _sql("SELECT CAST(max(m) AS BIGINT) AS max_row_size FROM (SELECT 2 * count(*) AS m FROM coded GROUP BY frame_no, y)", "wide", "wbits", _runs_sql("wbits", "frame_no, y", "x", 255)),
        "max_frames_limit": _sql(_all("gray8 WHERE frame_no < 10"), "gray8"),
        "memory_estimate": " UNION ALL ".join([memory("gray8", 64, 1, "embeddings"), memory("rgb8", 192, 64, "events"), memory("wide", 1024, 1024, "orders")]),
        "batch_sizes": " UNION ALL ".join(f"SELECT '{name}' AS clip_id, n AS whole, least(50, greatest(1, least(n, CAST(floor(0.01e0 * 1048576e0 / {size}) AS BIGINT)))) AS batch FROM (SELECT max({keys[table]}) // {each} + 1 AS n FROM {table})" for name, size, each, table in (("gray8", 64, 1, "embeddings"), ("rgb8", 192, 64, "events"), ("wide", 1024, 1024, "orders"))),
        "display_values": _sql("SELECT frame_no, y, x, CAST(c AS BIGINT) AS c, round(v / 255e0, 6) AS v FROM planes", "rgb8", "planes AS (SELECT frame_no, y, x, unnest([0, 1, 2]) AS c, unnest([r, g, b]) AS v FROM rgb8)"),
        "frame_captions": "SELECT vec_id AS frame_no, printf('Frame: %d/%d' || chr(10) || 'Time: %.2fs' || chr(10) || 'Resolution: 8x8' || chr(10) || 'Video FPS: 30.0' || chr(10) || 'Display FPS: N/A' || chr(10) || 'Color: GRAY', vec_id + 1, (SELECT count(*) FROM embeddings), vec_id / 30e0) AS caption FROM embeddings",
        "reached_rate": "SELECT event_id AS frame_no, round(CASE WHEN total > 0 THEN n * 1e6 / CAST(total AS DOUBLE) END, 6) AS rate FROM (SELECT event_id, count(gap) OVER w AS n, sum(gap) OVER w AS total FROM (SELECT event_id, user_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))",
        "frame_gather": _sql(_all("(SELECT 2 * ((SELECT max(vec_id) FROM embeddings) - frame_no) + again AS frame_no, y, x, v FROM gray8, generate_series(0, 1) AS s(again))"), "gray8"),
        "delta_gaps": _sql(_all("coded"), "gray8", "bits", "gappy", _delta_sql("gappy", 40)),
        "delta_gaps_decoded": _sql(_all("gappy"), "gray8", "bits", "gappy"),
        "delta_written_roundtrip": _sql(_all("bits"), "gray8", "bits"),
        "delta_decode_no_keys": _sql(_all("bits"), "gray8", "bits"),
        "dtype_clip_u16": "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(floor(least(65535e0, greatest(0e0, (value - 40e0) * 900.7e0))) AS BIGINT) AS v FROM events",
        "dtype_float": "SELECT CAST(event_id AS BIGINT) AS event_id, round((value - 40e0) * 900.7e0, 6) AS v FROM events",
        "noise_dither": _sql(_noise_sql(128), "gray8"),
        "floyd_steinberg": _diffusion_sql(128),
        "processing_summary": "SELECT CAST(k AS BIGINT) AS step, c AS component FROM (VALUES (1, 'reframe'), (2, 'resize'), (3, 'to_1bit')) AS s(k, c)",
        "pipeline_full": _sql(_all("coded"), "rgb8", *full),
        "scanline_mode": _sql(_all("bits", "CASE WHEN y % 2 = 0 THEN v ELSE 0 END"), "gray8", "bits"),
        "interlaced_mode": _sql(_all(f"({twice.format(own='CASE WHEN (y + frame_no) % 2 = 0 THEN v ELSE lag(v) OVER (PARTITION BY y, x ORDER BY frame_no) END')})"), "gray8", "bits"),
    }
    two = _sql(_all("vv", _U8), "gray8", _weights_sql("wx", 8, 5), _weights_sql("wy", 8, 11), _across("h", "gray8", "wx", "x", ""), _across("vv", "h", "wy", "y", ""))
    found |= {"lanczos_2d": two, "lanczos_2d_arrow": two}
    return found
