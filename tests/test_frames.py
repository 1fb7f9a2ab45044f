"""Golden vectors, error cases and properties of the frame engine."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frameloom.functions import lanczos, pixel
from frameloom.operators import delta, modes, onebit, reframe, resize
from frameloom.plans import chain, cli
from frameloom.schema import Clip, ProcessingError, binary_violations, to_pixels, to_scanlines
from frameloom.sources import frames

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def rgb(spark):
    return frames.from_array(spark, np.arange(72, dtype=np.uint8).reshape(3, 2, 4, 3), 30.0, "RGB", clip_id="rgb")


@pytest.fixture(scope="module")
def gray(spark):
    return frames.from_array(spark, np.arange(36, dtype=np.uint8).reshape(9, 2, 2, 1), 30.0, "gray", clip_id="gray")


def still(spark, rows, fps=24.0):
    return frames.from_array(spark, np.array([rows], dtype=np.uint8), fps, "GRAY")


def test_threshold_is_strict(spark):
    out = onebit.to_1bit(still(spark, [[0, 128], [200, 255]]), 128, stats=True)
    assert frames.to_array(out).tolist() == [[[0, 0], [1, 1]]]
    assert out.color_mode == "BW" and out.history[-1].component == "to_1bit"
    assert out.history[-1].parameters["white_pixels"] == 2


@pytest.mark.parametrize(
    ("pattern", "size", "rows"),
    [
        ("bayer2x2", 2, [[1, 0], [0, 1]]),
        ("bayer4x4", 4, [[1, 0, 1, 0], [0, 1, 0, 0], [1, 0, 1, 0], [0, 0, 0, 1]]),
        ("bayer8x8", 8, [[1, 0, 1, 0, 1, 0, 1, 0], [0, 1, 0, 0, 0, 1, 0, 0]]),
    ],
)
def test_ordered_dither(spark, pattern, size, rows):
    out = onebit.to_1bit(still(spark, [[120] * size] * size), 128, "ordered", pattern)
    assert frames.to_array(out)[0].tolist()[: len(rows)] == rows


def test_gray_cuts(spark):
    clip = frames.from_array(spark, np.array([[[[1, 1, 1], [16, 16, 16], [10, 20, 30], [255, 255, 255]]]], dtype=np.uint8), 1, "RGB")
    assert [r.planes[0] for r in onebit.to_gray(clip.scanlines).collect()] == [[0, 15, 18, 255]]


@pytest.mark.parametrize(
    ("rows", "bits"),
    [
        ([[100] * 4] * 4, [[0, 1, 0, 0], [0, 1, 0, 1], [0, 1, 0, 0], [0, 0, 1, 0]]),
        (np.arange(0, 256, 16).reshape(4, 4).tolist(), [[0, 0, 0, 0], [0, 0, 1, 0], [1, 1, 0, 1], [1, 1, 1, 1]]),
    ],
)
def test_floyd_steinberg(spark, rows, bits):
    assert frames.to_array(onebit.to_1bit(still(spark, rows), 128, "floyd_steinberg"))[0].tolist() == bits


def test_floyd_steinberg_matches_a_plain_loop():
    rng = np.random.default_rng(5)
    images = rng.integers(0, 256, (3, 7, 9))
    for image, got in zip(images, onebit.diffuse(images, 100), strict=True):
        work = image.astype(np.float32)
        want = np.zeros_like(image)
        for y in range(7):
            for x in range(9):
                old = float(work[y, x])
                new = 255.0 if old > 100 else 0.0
                want[y, x] = new > 0
                for dy, dx, share in ((0, 1, 7), (1, -1, 3), (1, 0, 5), (1, 1, 1)):
                    if y + dy < 7 and 0 <= x + dx < 9:
                        work[y + dy, x + dx] = np.float32(float(work[y + dy, x + dx]) + (old - new) * share / 16)
        assert got.tolist() == want.tolist()


def test_noise_dither_is_repeatable(spark, gray):
    a, b = (sorted(map(str, onebit.noise_dither(gray.scanlines, 20, seed=s).collect())) for s in (1, 1))
    assert a == b


def test_lanczos_weights():
    near = lambda table: [[round(w, 6) for _, w in taps] for taps in table]
    assert near(lanczos.weights(2, 1)) == [[0.5, 0.5]]
    assert near(lanczos.weights(4, 2)) == [[0.546949, 0.546949, -0.146717, 0.052818], [0.052818, -0.146717, 0.546949, 0.546949]]
    assert near(lanczos.weights(2, 4))[0] == [1.205515, -0.205515]
    with pytest.raises(NotImplementedError):
        lanczos.weights(4, 2, a=3)


@pytest.mark.parametrize("arrow", [False, True])
def test_resize_golden(rgb, arrow):
    out = resize.resize(rgb, (2, 1), arrow=arrow)
    assert out.resolution == (2, 1) and out.history[-1].component == "resize"
    assert frames.to_array(out).tolist() == [[[[7, 8, 9], [13, 14, 15]]], [[[31, 32, 33], [37, 38, 39]]], [[[55, 56, 57], [61, 62, 63]]]]


def test_resize_to_own_size_is_the_clip(rgb):
    assert resize.resize(rgb, (4, 2)) is rgb


def test_resize_forms_agree(spark):
    rng = np.random.default_rng(1)
    clip = frames.from_array(spark, rng.integers(0, 256, (2, 9, 13), dtype=np.uint8), 30, "GRAY")
    for target in ((5, 4), (20, 17), (13, 3)):
        native, arrow = (frames.to_array(resize.resize(clip, target, arrow=a)) for a in (False, True))
        assert (native == arrow).all()


def test_resize_refuses(rgb, spark):
    with pytest.raises(ProcessingError):
        resize.resize(rgb, (0, 2))
    with pytest.raises(ProcessingError):
        resize.resize(onebit.to_1bit(rgb), (2, 2))
    with pytest.raises(NotImplementedError):
        resize.resize(rgb, (2, 2), kernel_size=3)


@pytest.mark.parametrize(("fps", "want"), [(10, [0, 3, 6]), (12, [0, 2, 5]), (24, [0, 1, 2, 3, 5, 6, 7])])
def test_simple_reframe(gray, fps, want):
    rows = reframe.simple(gray.scanlines.filter("y = 0"), 9, 30.0, float(fps)).orderBy("out_no").collect()
    assert [r.frame_no for r in rows] == want and [r.out_no for r in rows] == list(range(len(want)))


@given(n=st.integers(1, 400), source=st.floats(5, 120), share=st.floats(0.05, 0.99))
@settings(max_examples=300, deadline=None)
def test_simple_reframe_slots(n, source, share):
    """The filter's guess of slots finds every index that a loop would."""
    r = source / (source * share)
    for i in range(int(n / r)):
        f = min(int(i * r), n - 1)
        guess = int(f / r)
        assert max(w for w in range(guess - 1, guess + 3) if w >= 0 and int(w * r) <= f) == i


@pytest.mark.parametrize(("fps", "want"), [(10, [1, 3, 6]), (12, [1, 2, 5]), (24, [0, 1, 2, 3, 5, 6, 7])])
def test_intelligent_reframe(gray, fps, want):
    rows = reframe.best_frames(reframe.frame_scores(gray.scanlines), 9, 30.0, float(fps)).orderBy("out_no").collect()
    assert [r.frame_no for r in rows] == want


def test_metrics(gray):
    assert {r.variance for r in reframe.frame_variance(gray.scanlines).collect()} == {1.25}
    assert [r.difference for r in reframe.frame_difference(gray.scanlines).orderBy("frame_no").collect()] == [0.0] + [4.0] * 8


def test_difference_of_other_shapes(spark):
    kind = "clip_id string, frame_no long, y int, planes array<array<int>>"
    lines = spark.createDataFrame([("a", 0, 0, [[1, 2]]), ("a", 1, 0, [[1, 5]]), ("a", 2, 0, [[1, 5, 7]]), ("a", 3, 0, [[1], [5], [7]])], kind)
    assert [r.difference for r in reframe.frame_difference(lines).orderBy("frame_no").collect()] == [0.0, 1.5, float("inf"), float("inf")]


def test_log_file(rgb, tmp_path):
    from frameloom.plans import log

    with log.to_file(str(tmp_path / "logs")) as path:
        chain.Chain().then(chain.one_bit(30)).run(rgb)
    chain.Chain().then(chain.one_bit(30)).run(rgb)
    lines = path.read_text().splitlines()
    assert len(lines) == 2 and all(line.count(" | ") == 3 for line in lines) and "to_1bit: 3 frames of 4x2" in lines[0]


def test_reframe_clip(gray):
    out = reframe.reframe(gray, 10, "simple")
    found = out.stats["reframe"]
    assert (out.frame_count, out.fps, found["output_frame_count"]) == (3, 10.0, 3)
    assert found["compression_ratio"] == pytest.approx(1 / 3) and found["frame_drop_percentage"] == pytest.approx(200 / 3)
    assert frames.to_array(out)[:, 0, 0].tolist() == [0, 12, 24]
    assert reframe.reframe(gray, 30.001) is gray
    with pytest.warns(UserWarning, match="sum to 1"):
        reframe.reframe(gray, 10, variance_weight=0.2)
    with pytest.raises(ProcessingError):
        reframe.reframe(gray, 60)
    custom = lambda lines, n, a, b: lines.filter("frame_no % 3 = 0").selectExpr("*", "frame_no div 3 as out_no")
    assert frames.to_array(reframe.reframe(gray, 10, custom))[:, 0, 0].tolist() == [0, 12, 24]


def test_chunks_do_not_show(gray):
    from frameloom.operators.neighbours import with_previous

    rows = lambda chunk: sorted(map(str, with_previous(gray.scanlines, chunk=chunk).collect()))
    assert rows(2) == rows(100) and len(rows(2)) == 18


def test_chunks_do_not_show_where_numbers_have_gaps(gray):
    from frameloom.operators.neighbours import with_previous

    lines = gray.scanlines.selectExpr("*", "explode(array(0, 4, 20)) AS o").selectExpr("clip_id", "frame_no + o AS frame_no", "y", "planes").filter("frame_no not in (1, 21)")
    rows = lambda chunk: sorted((r.frame_no, r.y, str(r.before)) for r in with_previous(lines, chunk=chunk).collect())
    assert rows(2) == rows(100) and sum(b == "None" for _, _, b in rows(2)) == lines.select("y").distinct().count()


def test_delta_golden(spark):
    clip = frames.from_array(spark, np.array([[[0, 0, 1, 1]], [[0, 1, 1, 0]]], dtype=np.uint8), 1, "BW")
    assert frames.to_array(delta.delta_encode_clip(clip)).tolist() == [[[0, 0, 1, 1]], [[0, 1, 0, 1]]]


def runs_of(spark, row, cap=255):
    lines = frames.from_array(spark, np.array([[row]], dtype=np.uint8), 1, "BW").scanlines
    return [(r.n, r.v) for r in delta.rle_rows(lines, cap=cap).first().runs]


def test_rle_golden(spark):
    assert runs_of(spark, [0, 0, 1, 1, 1, 0, 1, 0]) == [(2, 0), (3, 1), (1, 0), (1, 1), (1, 0)]
    assert runs_of(spark, [1] * 600 + [0] * 3) == [(255, 1), (255, 1), (90, 1), (3, 0)]
    frame = frames.from_array(spark, np.array([[[1, 1], [1, 0]]], dtype=np.uint8), 1, "BW").scanlines
    assert [(r.n, r.v) for r in delta.rle_frames(frame).first().runs] == [(3, 1), (1, 0)]
    sizes = delta.padded(delta.rle_rows(frames.from_array(spark, np.array([[[0, 0], [0, 1]]], dtype=np.uint8), 1, "BW").scanlines))
    assert sorted(r.bytes for r in sizes.collect()) == [[1, 0, 1, 1], [2, 0, 0, 0]]


@SLOW
@given(data=st.data())
def test_codecs_round_trip(spark, data):
    n, height, width = (data.draw(st.integers(1, k)) for k in (5, 3, 300))
    bits = np.random.default_rng(data.draw(st.integers(0, 999))).integers(0, 2, (n, height, width), dtype=np.uint8)
    clip = frames.from_array(spark, bits, 1, "BW")
    every = data.draw(st.sampled_from([None, 2]))
    assert (frames.to_array(delta.delta_decode_clip(delta.delta_encode_clip(clip, key_every=every))) == bits).all()
    coded = delta.rle_rows(clip.scanlines)
    assert all(1 <= r.n <= 255 for row in coded.collect() for r in row.runs)
    back = clip.but("rle", {}, scanlines=delta.rle_decode(coded))
    assert (frames.to_array(back) == bits).all()


def test_delta_refuses_other_values(gray):
    with pytest.raises(ProcessingError):
        delta.delta_encode_clip(gray)
    with pytest.raises(ProcessingError):
        delta.delta_encode_clip(gray.but("pretend", {}, color_mode="BW"))
    assert gray.scanlines.transform(binary_violations).first().n_bad == 34


def test_modes(spark):
    bits = np.stack([np.zeros((4, 2)), np.ones((4, 2))]).astype(np.uint8)
    lines = frames.from_array(spark, bits, 1, "BW")
    out = frames.to_array(lines.but("s", {}, scanlines=modes.scanline_mode(lines.scanlines)))
    assert out[1, :, 0].tolist() == [1, 0, 1, 0]
    out = frames.to_array(lines.but("i", {}, scanlines=modes.interlaced_mode(lines.scanlines)))
    assert out[1, :, 0].tolist() == [0, 1, 0, 1] and out[0].sum() == 0


def test_scanlines_and_pixels_are_one(rgb):
    assert sorted(map(str, to_scanlines(to_pixels(rgb.scanlines)).collect())) == sorted(map(str, rgb.scanlines.collect()))


def test_chain_moves_ratio_reframing_first(rgb):
    c = chain.Chain().then(chain.resizing(2, 2)).then(chain.one_bit(30)).then(chain.reframing(20.0, "simple"))
    assert [s.name for s in c.optimized().stages] == ["reframe", "resize", "to_1bit"]
    scored = chain.Chain().then(chain.resizing(2, 2)).then(chain.reframing(20.0))
    assert [s.name for s in scored.optimized().stages] == ["resize", "reframe"]
    moved = frames.to_array(c.run(rgb))
    plain = rgb
    for stage in c.stages:
        plain = stage.run(plain)
    assert (moved == frames.to_array(plain)).all()
    assert [s.component for s in plain.history] == ["resize", "to_1bit", "reframe"] and rgb.history == ()
    assert chain.summary(plain).count() == 3


def test_chain_names_the_stage_that_fails(rgb):
    def fails(clip):
        raise ValueError("no")

    with pytest.raises(ProcessingError) as e:
        chain.Chain((chain.Stage("odd", fails),)).run(rgb)
    assert e.value.component == "odd" and "original_exception" in e.value.details


def test_clips_are_checked(spark, rgb):
    with pytest.raises(ProcessingError):
        frames.from_array(spark, np.zeros((2, 2)), 1, "GRAY")
    with pytest.raises(ProcessingError):
        frames.from_array(spark, np.zeros((1, 2, 2), dtype=np.uint8), 1, "RGB")
    with pytest.raises(ProcessingError):
        frames.from_array(spark, np.zeros((1, 2, 3), dtype=np.uint8), 1, "GRAY", resolution=(2, 3))
    with pytest.raises(ProcessingError):
        Clip(rgb.scanlines, "x", 30.0, 4, 2, "CMYK", 1)
    with pytest.raises(ValueError, match="dither"):
        pixel.matrix("bayer3x3")
    assert rgb.memory()["total_bytes"] == 72 and "4x2" in rgb.info(0)


@pytest.mark.parametrize("layout", ["scanlines", "frames"])
def test_written_clips_come_back(spark, rgb, tmp_path, layout):
    frames.write_clip(rgb, str(tmp_path), layout=layout)
    back = frames.read_clip(spark, str(tmp_path))
    assert (frames.to_array(back) == frames.to_array(rgb)).all() and back.resolution == (4, 2)
    assert frames.read_clip(spark, str(tmp_path), max_frames=2).scanlines.select("frame_no").distinct().count() == 2


def test_raw_source_and_command_line(spark, tmp_path):
    raw = np.arange(5 * 4 * 6, dtype=np.uint8)
    (tmp_path / "clip.raw").write_bytes(raw.tobytes() + b"rest")
    out = cli.main(["-i", str(tmp_path / "clip.raw"), "--raw", "6x4x1", "-o", str(tmp_path / "out"), "-t", "60", "-f", "15", "--reframe-technique", "simple", "--rle"], spark)
    want = (raw.reshape(5, 4, 6)[[0, 2]] > 60).astype(int)
    want[1] ^= want[0]
    assert (frames.to_array(frames.read_clip(spark, str(tmp_path / "out"))) == want).all()
    assert [s.component for s in out.history] == ["reframe", "to_1bit", "delta_encode"]
    assert spark.read.parquet(str(tmp_path / "out/rle")).count() == 8
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["-i", "a", "-o", "b", "-r", "120"])


def test_files_through_a_decoder(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.mp4").write_bytes(bytes([k] * 12))

    def decoder(body):
        return frames.VideoInfo(3, 2), iter(np.frombuffer(body, np.uint8).reshape(2, 2, 3, 1))

    rows = frames.read_files(spark, str(tmp_path), decoder).collect()
    assert len(rows) == 4 and {len(r.pixels) for r in rows} == {6} and rows[1].ts == pytest.approx(1 / 30)
    with pytest.warns(UserWarning):
        frames.check_name("clip.txt")
    with pytest.raises(ValueError, match="picture"):
        frames.check_info(frames.VideoInfo(0, 2))
    assert frames.estimated_frames(frames.VideoInfo(1, 1, 25.0, None, 2.0)) == 50 and frames.estimated_frames(frames.VideoInfo(1, 1), 7) == 7


def test_streamed_delta(spark, tmp_path):
    from frameloom.streaming.delta import delta_encode_stream

    kind = "clip_id string, frame_no long, y int, row array<int>"
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (6, 2, 5)).tolist()
    for k in range(0, 6, 3):
        spark.createDataFrame([("a", n, y, bits[n][y]) for n in range(k, k + 3) for y in range(2)], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = delta_encode_stream(stream).writeStream.format("memory").queryName("coded").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        query.processAllAvailable()
        got = {(r.frame_no, r.y): r.row for r in spark.table("coded").collect()}
        # A late frame and a repeated one come out raw and marked; the next one follows the last on time.
        spark.createDataFrame([("a", n, 0, bits[k][0]) for n, k in ((2, 1), (6, 0), (6, 4), (7, 2))], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query.processAllAvailable()
        more = sorted((r.frame_no, r.late, r.row) for r in spark.table("coded").filter("frame_no > 5 or late").collect())
    finally:
        query.stop()
    xor = lambda p, q: [a ^ b for a, b in zip(p, q, strict=True)]
    assert more[0] == (2, True, bits[1][0]) and sorted(x[:2] for x in more) == [(2, True), (6, False), (6, True), (7, False)]
    first = next(x[2] for x in more if x[:2] == (6, False))
    late = next(x[2] for x in more if x[:2] == (6, True))
    before = xor(first, bits[5][0])
    assert {tuple(before), tuple(late)} == {tuple(bits[0][0]), tuple(bits[4][0])} and more[-1][2] == xor(bits[2][0], before)
    assert len(got) == 12
    for (n, y), row in got.items():
        assert row == (bits[0][y] if n == 0 else [a ^ b for a, b in zip(bits[n][y], bits[n - 1][y], strict=True)])


def test_clips_of_files(spark, tmp_path):
    """A file with its metadata, in both color modes; frames are counted."""
    pictures = np.arange(2 * 3 * 4 * 3, dtype=np.uint8).reshape(2, 3, 4, 3)
    (tmp_path / "video.mp4").write_bytes(pictures.tobytes())

    def decoder(body):
        return frames.VideoInfo(4, 3, 30.0, 90, 3.0, "h264", "yuv420p"), iter(np.frombuffer(body, np.uint8).reshape(-1, 3, 4, 3))

    path = str(tmp_path / "video.mp4")
    clip = frames.read_video(spark, path, decoder)
    assert (frames.to_array(clip) == pictures).all() and (clip.resolution, clip.fps, clip.frame_count, clip.duration) == ((4, 3), 30.0, 2, 2 / 30)
    assert clip.source == {"source_file": path, "original_duration": 3.0, "codec": "h264", "pixel_format": "yuv420p"}
    assert clip.history[0].component == "read_video"
    gray = frames.read_video(spark, path, decoder, color_mode="gray", max_frames=1, keep=str(tmp_path / "kept"))
    assert gray.color_mode == "GRAY" and (frames.to_array(gray)[0] == np.array(onebit.to_gray(clip.scanlines).filter("frame_no = 0").orderBy("y").selectExpr("planes[0]").toPandas().iloc[:, 0].tolist())).all()
    one = lambda body: (frames.VideoInfo(4, 3), iter(np.frombuffer(body, np.uint8)[:12].reshape(1, 3, 4)))
    assert (frames.to_array(frames.read_video(spark, path, one))[..., 2] == pictures.reshape(-1)[:12].reshape(1, 3, 4)).all()
    with pytest.raises(ValueError, match="RGB or GRAY"):
        frames.read_video(spark, path, decoder, color_mode="BW")
    info = frames.file_infos(spark, path, decoder).first()
    assert (info.codec, info.expected) == ("h264", 90)


def test_frames_to_files(spark, rgb):
    """An encoder plug-in gets the frames in order, in runs."""

    def encoder(info, pictures):
        own = list(pictures)
        return bytes([info.width, info.height, len(own)]) + b"".join(p.tobytes() for p in own)

    plain = frames.to_array(rgb)
    rows = frames.encode_files(rgb, encoder, frames_per_file=2).orderBy("part").collect()
    assert [(r.first_frame, r.n_frames) for r in rows] == [(0, 2), (2, 1)]
    assert b"".join(bytes(r.content)[3:] for r in rows) == plain.tobytes() and bytes(rows[0].content)[:3] == bytes([4, 2, 2])
    bits = onebit.to_1bit(rgb, 30)
    content = bytes(frames.encode_files(bits, encoder).first().content)[3:]
    assert content == np.repeat(frames.to_array(bits)[..., None] * 255, 3, axis=3).astype(np.uint8).tobytes()


@pytest.mark.parametrize("layout", ["scanlines", "frames"])
@pytest.mark.parametrize("key_every", [None, 5])
def test_written_deltas_are_decoded(spark, tmp_path, layout, key_every):
    bits = np.random.default_rng(4).integers(0, 2, (20, 3, 6), dtype=np.uint8)
    coded = chain.Chain().then(chain.delta_coding(key_every)).run(frames.from_array(spark, bits, 12.5, "BW"))
    frames.write_clip(coded, str(tmp_path), layout=layout)
    back = frames.read_clip(spark, str(tmp_path))
    assert back.stats == coded.stats and back.history == coded.history
    assert (frames.to_array(delta.delta_decode_clip(back)) == bits).all()


def test_deltas_over_gaps(spark):
    """Numbers without the key frames and the ends of chunks."""
    bits = np.random.default_rng(5).integers(0, 2, (700, 2, 3), dtype=np.uint8)
    lines = frames.from_array(spark, bits, 1, "BW").scanlines.filter("frame_no not in (0, 5, 10, 255, 256, 400) and frame_no not between 500 and 620")
    rows = lambda df: sorted((r.frame_no, r.y, str(r.planes)) for r in df.collect())
    want = rows(lines)
    for every in (None, 5, 256):
        coded = delta.delta_encode(lines, key_every=every)
        assert rows(delta.delta_decode(coded, key_every=every)) == want
    assert rows(delta.delta_decode(delta.delta_encode(lines), chunk=3)) == want


def test_decoded_planes_of_any_shape(spark):
    """Several channels, clips of different sizes, values beyond one bit."""
    rng = np.random.default_rng(6)
    kind = "clip_id string, frame_no long, y int, planes array<array<int>>"
    shapes = {"a": (2, 5), "b": (1, 9), "c": (3, 1)}
    rows = [(name, n, y, rng.integers(0, 1000, shape).tolist()) for name, shape in shapes.items() for n in range(30) for y in range(2)]
    lines = spark.createDataFrame(rows, kind)
    back = delta.delta_decode(delta.delta_encode(lines), chunk=7)
    assert sorted(map(str, back.select(*lines.columns).collect())) == sorted(map(str, lines.collect()))


def test_command_line_rules(spark):
    parse = lambda *more: cli.parser().parse_args(["-i", "a", "-o", "b", *more])
    for bad in (["--interlaced", "--rle"], ["--interlaced", "--delta"], ["--interlaced", "--mc"], ["--scanline", "--interlaced"], ["--scanline", "--mc"], ["--mc"], ["-c", "0"], ["-it"], ["-lc", "1"], ["-f", "0"], ["-f", "60"], ["-t", "300"], ["-w", "0"], ["-b", "0"]):
        with pytest.raises(SystemExit):
            cli.plan(parse(*bad), 30.0)
    names = lambda *more: [s.name for s in cli.plan(parse(*more), 30.0).stages]
    assert names("--scanline", "--rle", "-w", "2", "-e", "threading", "-b", "50") == ["to_1bit", "scanline", "delta_encode"]
    assert names("--interlaced", "--dither") == ["to_1bit", "interlaced"] and parse("--dither-method", "floyd-steinberg").dither_method == "floyd_steinberg"


def test_progress_and_other_resizers(rgb):
    seen = []
    halved = lambda lines, size, target, dtype: lines.filter("y = 0").selectExpr("clip_id", "frame_no", "y", "transform(planes, p -> slice(p, 1, 2)) AS planes")
    out = chain.Chain().then(chain.resizing(2, 1, using=halved)).then(chain.one_bit(30)).run(rgb, lambda *x: seen.append(x))
    assert out.resolution == (2, 1) and frames.to_array(out).shape == (3, 1, 2)
    assert [x[:2] for x in seen] == [(1, 2), (2, 2)] and seen[1][2] >= seen[0][2] >= 0
    progress = chain.Progress(30)
    for _ in range(15):
        progress.step()
    progress.finish()
    assert len(progress.times) == 10 and progress.done == 30 and progress.recent >= 0 and chain.Progress(1).recent is None


@pytest.mark.parametrize("dtype", ["uint16", "float32", "float64"])
def test_resize_keeps_the_type(spark, dtype):
    rng = np.random.default_rng(7)
    values = (rng.random((2, 6, 7)) * 60000 - (0 if dtype == "uint16" else 30000)).astype(dtype)
    clip = frames.from_array(spark, values, 30, "GRAY")
    for arrow in (False, True):
        out = resize.resize(clip, (4, 9), arrow=arrow)
        got = frames.to_array(out)
        want = np.stack([lanczos.resize_array(f, 4, 9) for f in values.astype(np.float64)])
        want = np.clip(want, 0, 65535).astype(np.uint16) if dtype == "uint16" else want.astype(dtype)
        assert out.dtype == dtype and got.dtype == dtype and (got == want).all()


def test_display_tables(spark, rgb, gray):
    from frameloom.operators import display

    assert display.normalise(rgb).filter("frame_no = 0 and y = 0").first().planes[0][1] == pytest.approx(3 / 255)
    assert len(display.normalise(gray).first().planes) == 1
    assert display.captions(rgb).orderBy("frame_no").first().caption == rgb.info(0)
    done = onebit.to_1bit(rgb)
    shown = display.captions(done, spark.createDataFrame([(1, 24.96)], "frame_no long, rate double")).orderBy("frame_no").collect()
    assert [r.caption for r in shown] == [done.info(0), done.info(1, 24.96), done.info(2)] and "Last Process: to_1bit" in shown[0].caption and "Display FPS: 25.0" in shown[1].caption
    shown = spark.createDataFrame([("a", k * 50_000, k) for k in range(40)] + [("b", 5, 0)], "clip_id string, shown_us long, frame_no long")
    rates = {(r.clip_id, r.frame_no): r.rate for r in display.reached_rate(shown).collect()}
    assert rates["a", 0] is None and rates["b", 0] is None and rates["a", 39] == pytest.approx(20.0)
    picked = display.gather(gray.scanlines, spark.createDataFrame([(0, 8), (1, 8), (2, 0)], "out_no long, frame_no long"))
    assert picked.count() == 6
    assert gray.batch_size() == 9 and gray.batch_size(single_mb=0, batch_mb=8 / 2**20) == 2 and gray.batch_size(1, single_mb=0) == 1
