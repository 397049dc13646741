"""The capture side: streams over files that grow, batches with their points, numbered frames, and all of it chained."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudloom.operators.batches import accumulate as sizes_of_batches
from cloudloom.sources import pcd, png, tables
from cloudloom.sources.config import CaptureConfig
from cloudloom.streaming import accumulate, capture, frames, sources, topology


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", topology._ROCKSDB)
    for source in (pcd.PcdDataSource, sources.ScanDataSource, sources.TailDataSource):
        spark.dataSource.register(source)


def write_scan(folder, k, points):
    body = "".join(f"{x} {y} {z}\n" for x, y, z in points)
    head = f"VERSION 0.7\nFIELDS x y z\nSIZE 4 4 4\nTYPE F F F\nCOUNT 1 1 1\nWIDTH {len(points)}\nHEIGHT 1\nPOINTS {len(points)}\nDATA ascii\n"
    folder.mkdir(exist_ok=True)
    (folder / f".scan_{k:06d}").write_text(head + body)
    os.replace(folder / f".scan_{k:06d}", folder / f"scan_{k:06d}.pcd")


def some_scan(k):
    rng = random.Random(k)
    return [tuple(rng.randrange(-20, 20) / 4 for _ in "xyz") for _ in range(0 if k % 5 == 3 else 5 + k % 7)]


def drained(spark, frame, folder, name, mode="append"):
    """Runs a stream to its end into a table of rows that outlives the query."""
    frame.writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/state-{name}").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")


def test_scan_files_once_each_and_as_in_a_batch_read(spark, tmp_path):
    def read():
        return drained(spark, spark.readStream.format("scans").option("session", 4).load(str(tmp_path / "in")), tmp_path, "out")

    for k in range(3):
        write_scan(tmp_path / "in", k, some_scan(k))
    assert read().count() == 3
    for k in range(3, 6):
        write_scan(tmp_path / "in", k, some_scan(k))
    found = read()  # a new query from the same checkpoint
    batch = spark.read.format("scans").option("session", 4).load(str(tmp_path / "in"))
    assert found.exceptAll(batch).count() == 0 and found.count() == batch.count() == 6
    assert {r["index"]: len(r["x"]) for r in found.collect()} == {k: len(some_scan(k)) for k in range(6)} and found.first()["session_id"] == 4
    assert read().count() == 6


def test_growing_table_by_whole_lines_and_ranges(spark, tmp_path):
    path = tmp_path / "odom.csv"
    lines = [f"{k},{k},5,{k / 4},0.5,0,0,0,0,1\n" for k in range(50)]

    def read():
        stream = spark.readStream.format("growing_csv").schema(tables.ODOM).option("span", 70).load(str(path))
        return sorted(r["index"] for r in drained(spark, stream, tmp_path, "out").collect())

    path.write_text(tables.ODOM.replace(" INT", "").replace(" LONG", "").replace(" DOUBLE", "").replace(", ", ",") + "\n" + "".join(lines[:20]) + lines[20][:7])
    assert read() == list(range(20))
    with path.open("a") as file:
        file.write(lines[20][7:] + "".join(lines[21:]))
    assert read() == list(range(50)) and read() == list(range(50))
    batch = spark.read.format("growing_csv").schema(tables.ODOM).option("span", 33).load(str(path))
    assert batch.exceptAll(tables.read_odom(spark, str(path))).count() == 0 and batch.count() == 50
    with path.open("a") as file:
        file.write("x,not a number\n")
    with pytest.raises(Exception):
        spark.read.format("growing_csv").schema(tables.ODOM).load(str(path)).collect()


def as_rows(df):
    return sorted((r.session_id, r.batch, r.last_index, r.by_size, r.n, *(round(v, 6) for v in (r.x, r.y, r.z))) for r in df.collect())


@pytest.mark.parametrize(("most", "every", "drop"), [(30, 4, False), (30, 4, True), (1000, 3, False), (25, 0, False)])
def test_batches_with_points_over_restarts(spark, tmp_path, most, every, drop):
    rows = []
    for session in (1, 2):
        for k in range(14):
            xyz = [[p[a] for p in some_scan(k + 50 * session)] for a in range(3)]
            rows.append((session, k, *xyz, False))
    kind = sources.SCANS

    def read():
        return drained(spark, accumulate.gathered(spark.readStream.schema(kind).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in")), most, every, 1.0, drop), tmp_path, "out")

    def add(part):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    for k in range(0, 14, 5):
        add([r for r in rows if k <= r[1] < k + 5])
        partly = as_rows(read())  # each call is a query of its own from the same checkpoint
    whole = spark.createDataFrame(rows, kind)
    closed = as_rows(accumulate.gathered_batch(whole, most, every, 1.0, drop_tail=True))
    assert partly == closed
    for _ in range(2):  # a second end adds nothing
        add([(s, None, None, None, None, True) for s in (1, 2)])
        assert as_rows(read()) == as_rows(accumulate.gathered_batch(whole, most, every, 1.0, drop))
    by_size = {r[3] for r in closed}
    assert by_size == ({True, False} if most == 30 else {most == 25})


def test_sizes_without_count_trigger(spark):
    scans = spark.createDataFrame([(1, k, 10) for k in range(7)], "session_id long, index long, n_points long")
    assert sorted((r.batch, r.n_points, r.by_size) for r in sizes_of_batches(scans, 30, 0).collect()) == [(0, 30, True), (1, 30, True), (2, 10, False)]


def test_whole_paths(spark, tmp_path):
    poses = [(1, k, float(k), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for k in range(9)]
    kind = "session_id long, index long, px double, py double, pz double, qx double, qy double, qz double, qw double"
    for part in (poses[:4], poses[4:]):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = capture.stream_table(spark, str(tmp_path / "in"), kind)
    found = {r["index"]: [p["px"] for p in r["path"]] for r in drained(spark, capture.paths(stream, 3, whole=True), tmp_path, "out").collect()}
    assert found == {k: [float(v) for v in range(max(0, k - 2), k + 1)] for k in range(9)}


def frame_rows(indices, session=1, broken=()):
    return [(session, k, 100 + k, 7, 2, 2, "rgb8", bytes([k % 256] * (11 if k in broken else 12))) for k in indices]


def test_frames_are_numbered_by_what_was_saved(spark, tmp_path):
    sink = frames.FrameSink(str(tmp_path / "frames"), 2, "shot")
    first, second = frame_rows(range(1, 9), broken={4}), frame_rows(range(9, 14)) + frame_rows(range(4), session=2)
    sink.update(spark.createDataFrame(first, frames.FRAMES), 0)
    sink.update(spark.createDataFrame(second, frames.FRAMES), 1)
    want = [(1, 2, 0), (1, 6, 1), (1, 8, 2), (1, 10, 3), (1, 12, 4), (2, 1, 0), (2, 3, 1)]

    def look():
        rows = sorted((r.session_id, r["index"], r.saved) for r in sink.saved(spark, 1).collect())
        files = {s: sorted(n for n in os.listdir(tmp_path / "frames" / "images" / str(s)) if not n.startswith(".")) for s in (1, 2)}
        return rows, files

    assert look() == (want, {1: [f"shot_{k:06d}.png" for k in range(5)], 2: [f"shot_{k:06d}.png" for k in range(2)]})
    sink.update(spark.createDataFrame(second, frames.FRAMES), 1)  # a repeated epoch
    assert look()[0] == want and len(look()[1][1]) == 5
    image = png.decode_png((tmp_path / "frames" / "images" / "1" / "shot_000003.png").read_bytes())
    assert image.shape == (2, 2, 3) and (image == 10).all()
    assert sink.export(spark, 1, 1, str(tmp_path / "image.csv")) and not sink.export(spark, 1, 9, str(tmp_path / "none.csv"))
    assert [(r["index"], r["filename"], r["timestamp_sec"]) for r in tables.read_image_index(spark, str(tmp_path / "image.csv")).collect()][:2] == [(0, "shot_000000.png", 102), (1, "shot_000001.png", 106)]
    assert not os.path.exists(tmp_path / "none.csv")


def test_frame_encodings():
    data = bytes(range(12))
    assert (png.decode_png(frames.encoded_frame(2, 2, "bgr8", data))[0, 0] == [2, 1, 0]).all()
    assert png.decode_png(frames.encoded_frame(4, 3, "mono8", data)).shape == (3, 4)
    for bad in [(2, 2, "rgb8", data[:-1]), (2, 2, "yuv", data)]:
        with pytest.raises((ValueError, KeyError)):
            frames.encoded_frame(*bad)


def test_whole_capture_over_a_restart(spark, tmp_path):
    settings = CaptureConfig(output_dir=str(tmp_path / "out"), image_save_interval=2, image_prefix="frame", odom_save_interval=3, leaf_size=1.0, max_path_length=4, accumulator_max_points=30,
                             accumulator_publish_interval=4, global_downsample_interval=5, global_max_points=60, lidar_topic="", odom_topic="", image_topic="", frame_id="")

    def made():
        scans = spark.readStream.format("scans").option("session", 1).load(str(tmp_path / "scans"))
        odom, shots = (capture.stream_table(spark, str(tmp_path / n), k) for n, k in (("odom", topology.ODOM), ("frames", frames.FRAMES)))
        return topology.Capture(spark, settings, scans, odom, shots)

    def feed(numbers):
        for k in numbers:
            write_scan(tmp_path / "scans", k, some_scan(k))
        poses = [(1, k, k, 0, float(k), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for k in numbers]
        spark.createDataFrame(poses, topology.ODOM).coalesce(1).write.mode("append").parquet(str(tmp_path / "odom"))
        spark.createDataFrame(frame_rows(numbers, broken={3}), frames.FRAMES).coalesce(1).write.mode("append").parquet(str(tmp_path / "frames"))

    feed(range(8))
    made().run_available()
    feed(range(8, 13))
    running = made()
    running.start(("accumulator", "frames"), processingTime="1 second")  # stopped in the middle, as by a crash
    running.stop()
    done = made().finish([1])
    assert done == {"map": True, "image-1": True, "odom-1": True}

    scans = spark.read.format("scans").option("session", 1).load(str(tmp_path / "scans"))
    batches = accumulate.gathered_batch(scans, 30, 4, 1.0)
    assert as_rows(spark.read.parquet(str(tmp_path / "out" / "batches"))) == as_rows(batches)
    cloud = spark.read.format("pcd").load(str(tmp_path / "out" / "pcd" / "input.pcd"))
    epochs = topology.finished_epochs(spark, str(tmp_path / "out" / "map" / "manifest"))
    held = made().map.cells(spark, epochs[-1])
    assert cloud.count() == held.count() and held.agg(F.sum("n")).first()[0] == batches.count()
    path = spark.read.parquet(str(tmp_path / "out" / "path"))
    assert sorted((r["index"], r["first_index"]) for r in path.collect()) == [(k, max(0, k - 3)) for k in range(13)]
    shots = tables.read_image_index(spark, str(tmp_path / "out" / "timestamps" / "1" / "image.csv")).collect()
    assert [(r["index"], r["timestamp_sec"] - 100) for r in shots] == [(k, v) for k, v in enumerate([1, 5, 7, 9, 11])]
    odom = tables.read_odom(spark, str(tmp_path / "out" / "timestamps" / "1" / "odom.csv")).collect()
    assert [r["px"] for r in odom] == [2.0, 5.0, 8.0, 11.0]


def test_voxel_means():
    points = np.array([[0.1, 0.1, 0.1], [0.3, 0.1, 0.1], [-0.5, 0.0, 0.0], [math.nan, 0, 0]])
    means, n = accumulate.voxel_means(points, 1.0)
    assert means.tolist() == [[-0.5, 0.0, 0.0], [0.2, 0.1, 0.1]] and n.tolist() == [1, 2]
    assert len(accumulate.voxel_means(points[3:], 1.0)[0]) == 0
