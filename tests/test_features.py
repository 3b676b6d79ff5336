from __future__ import annotations

import os
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from images import LABELS, draw_image, draw_tree
from tessera import sinks, sources
from tessera.operators import features, pixels, weights
from tessera.operators.profile import vector_length_check

# The models below travel to the workers with the UDF.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    root = draw_tree(spark, tmp_path_factory.mktemp("images"))
    draw_image(spark, root / LABELS[2] / "grey.jpg", 90, 90, 90, side=60, grey=True)
    return root


def mean_model(weights):
    """Mean of each channel, times a weight."""
    return lambda batch: batch.mean(axis=(1, 2), dtype=np.float64) * weights[0]


def by_path(df):
    return {r.path: r.features for r in df.collect()}


def test_scaling_and_constant_images():
    assert pixels.scale_pixels(np.array([0, 255], dtype=np.uint8)).tolist() == [-1.0, 1.0]
    flat = [np.full((h, w, 3), 77, dtype=np.uint8) for h, w in [(100, 100), (30, 500), (224, 224)]]
    resized = pixels.resize_all(flat)
    assert resized.shape == (3, 224, 224, 3)
    assert (resized == 77).all()


def test_resize_keeps_order_and_gradients():
    ramp = np.repeat(np.arange(0, 200, 2, dtype=np.uint8)[None, :, None], 100, axis=0)
    ramp = np.repeat(ramp, 3, axis=2)
    other = np.zeros((50, 50, 3), dtype=np.uint8)
    resized = pixels.resize_all([other, ramp, other])
    assert not resized[0].any() and not resized[2].any()
    assert (np.diff(resized[1, 0, :, 0].astype(int)) >= 0).all()
    assert (resized[1] == resized[1][0]).all()
    assert abs(resized[1, 0, 112, 0].astype(int) - 99) <= 1


def test_cubic_weights():
    weights = pixels._bicubic(100, 224)
    assert weights.shape == (224, 100)
    assert np.allclose(weights.sum(axis=1), 1)
    assert ((weights != 0).sum(axis=1) <= 4).all()
    assert ((pixels._bicubic(448, 224) != 0).sum(axis=1) > 4).all()


def test_image_features_of_a_tree(spark, tree, tmp_path):
    images = sources.decode_images(spark, str(tree))
    table = features.image_features(images, features.pooled_weights())
    assert table.columns == ["path", "label", "features"]
    sinks.write_parquet(table, str(tmp_path / "features"))
    stored = sources.read_parquet(spark, str(tmp_path / "features"))
    assert dict(stored.dtypes)["features"] == "array<float>"
    assert stored.count() == 14
    missing = stored.where("features IS NULL").collect()
    assert [r.path.rsplit("/", 1)[1] for r in missing] == ["broken.jpg"]
    check = vector_length_check(stored.where("features IS NOT NULL"), "features", 1280)
    assert check.collect() == [(13, 1280, 1280, 0)]


def test_channels_reach_the_model_as_rgb(spark, tree):
    images = sources.decode_images(spark, str(tree))
    means = by_path(features.image_features(images, [np.ones(3)], mean_model))
    red = next(v for p, v in means.items() if p.endswith(f"{LABELS[0]}/0_100.jpg"))
    expected = np.array([20, 200, 128]) / 127.5 - 1
    assert np.allclose(red, expected, atol=0.03)
    grey = next(v for p, v in means.items() if p.endswith("grey.jpg"))
    assert np.ptp(grey) < 1e-6


def test_batch_size_and_partitions_do_not_matter(spark, tree):
    images = sources.decode_images(spark, str(tree))
    weights = features.pooled_weights()
    expected = by_path(features.image_features(images, weights))
    for options in ({"batch_rows": 1}, {"batch_rows": 3, "partitions": 5}):
        got = by_path(features.image_features(images, weights, **options))
        assert got.keys() == expected.keys()
        for path, vector in expected.items():
            assert (got[path] is None) == (vector is None)
            if vector is not None:
                assert np.allclose(got[path], vector, atol=1e-5)


def test_policies_for_corrupt_images(spark, tree):
    images = sources.decode_images(spark, str(tree))
    weights = [np.ones(3)]
    assert features.image_features(images, weights, mean_model, on_error="drop").count() == 13
    with pytest.raises(PySparkException, match="broken.jpg"):
        features.image_features(images, weights, mean_model, on_error="raise").collect()
    with pytest.raises(ValueError):
        features.image_features(images, weights, mean_model, on_error="ignore")


def raw_decode(content: bytes) -> np.ndarray:
    """Two size bytes, then RGB pixels."""
    height, width = content[0], content[1]
    if len(content) != 2 + height * width * 3:
        raise ValueError("wrong length")
    return np.frombuffer(content[2:], dtype=np.uint8).reshape(height, width, 3)


def test_features_of_stored_bytes(spark):
    rows = [(f"x/{i}", "c", bytes([2, 2] + [10 * i] * 12)) for i in range(5)] + [("x/bad", "c", b"\x02\x02a")]
    stored = spark.createDataFrame(rows, "path string, label string, content binary")
    table = features.content_features(
        stored, [np.ones(3)], mean_model, decode=raw_decode, batch_rows=2
    )
    got = {r.path: r for r in table.collect()}
    assert got["x/bad"].features is None and got["x/bad"].error == "wrong length"
    for i in range(5):
        assert np.allclose(got[f"x/{i}"].features, 10 * i / 127.5 - 1)
        assert got[f"x/{i}"].error is None


def test_model_errors_are_not_taken_for_bad_images(spark, tree):
    def failing_model(weights):
        def predict(batch):
            raise TypeError("model went wrong")

        return predict

    images = sources.decode_images(spark, str(tree))
    with pytest.raises(PySparkException, match="model went wrong"):
        features.image_features(images, [], failing_model).collect()


def test_vectors_keep_rows_and_nulls(spark):
    rows = [(i, [float(i), 1.0]) for i in range(20)] + [(20, None)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    table = features.vector_features(
        df, "v", [np.array([[2.0, 0.0], [0.0, 3.0]])], batch_rows=3, keep=["id"]
    )
    got = {r.id: r.features for r in table.collect()}
    assert got.pop(20) is None
    assert got == {i: [2.0 * i, 3.0] for i in range(20)}


def test_inference_runs_once_per_row(spark):
    """One Python evaluation, though the result is used in several columns."""
    df = spark.range(10).select("id", F.array(F.col("id").cast("float")).alias("v"))
    table = features.vector_features(df, "v", [np.array([[1.0]])], keep=["id"])
    used = table.select(F.size("features"), F.element_at("features", 1))
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("batch_rows", [1, 3, 100])
def test_batches_are_bounded_by_rows_and_bytes(batch_rows):
    draw = np.random.default_rng(batch_rows)
    sizes = [*draw.integers(0, 400, 60), 5_000, 1, 1_000, 1, 1_000, 999, 1]
    arrays = [np.zeros(size, np.uint8) for size in sizes]
    batches = list(features.bounded_batches(enumerate(arrays), batch_rows, 1_000))
    assert [row for rows, _ in batches for row in rows] == list(range(len(sizes)))
    for rows, held in batches:
        assert len(rows) == len(held) <= batch_rows
        assert len(rows) == 1 or sum(a.nbytes for a in held) <= 1_000
    for (rows, held), (_, after) in zip(batches, batches[1:]):
        assert len(rows) == batch_rows or sum(a.nbytes for a in held) + after[0].nbytes > 1_000


def test_inputs_are_read_as_batches_are_taken():
    read = []

    def inputs():
        for row in range(100):
            read.append(row)
            yield row, np.zeros(10, np.uint8)

    batches = features.bounded_batches(inputs(), 100, 50)
    next(batches)
    assert len(read) == 6
    assert list(features.bounded_batches([], 1, 1)) == []
    with pytest.raises(ValueError):
        next(features.bounded_batches(inputs(), 0, 1))


def wide_decode(content: bytes) -> np.ndarray:
    """A height of eight bytes, an image of 1,000 columns."""
    return np.full((int.from_bytes(content[:8], "little"), 1000, 3), content[8], np.uint8)


def count_model(weights):
    """How many images the model was given at once, and the mean shade of each."""
    return lambda batch: np.stack(
        [np.full(len(batch), len(batch)), np.rint((batch.mean(axis=(1, 2, 3)) + 1) * 127.5)], axis=1
    )


def test_images_of_one_kilobyte_to_fifty_megabytes(spark):
    """3 KB to 50 MB of pixels: at most 30 MB go into a batch, or one larger image."""
    heights = [1, 1, 16_700, 1, 3_000, 7_000, 3_000, 1, 10_000, 16_700, 1, 1, 1]
    rows = [(i, h.to_bytes(8, "little") + bytes([10 + i])) for i, h in enumerate(heights)]
    stored = spark.createDataFrame(rows, "id long, content binary").coalesce(1)
    table = features.content_features(
        stored, [], count_model, decode=wide_decode, batch_bytes=30_000_000, keep=["id"]
    )
    got = {r.id: r.features for r in table.collect()}
    assert [got[i][0] for i in range(13)] == [2, 2, 1, 2, 2, 2, 2, 1, 1, 1, 3, 3, 3]
    assert [got[i][1] for i in range(13)] == [10 + i for i in range(13)]


def test_arrow_batches_are_bounded_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(0, 200, 1, 1).select("id", F.expr("cast(repeat('x', 100000) AS binary)").alias("content"))

    @F.pandas_udf("long")
    def held(content):
        import pandas as pd

        return pd.Series([sum(map(len, content))] * len(content))

    def most():
        return max(r[0] for r in rows.select(held("content")).collect())

    assert most() == 20_000_000
    before = spark.conf.get(name)
    spark.conf.set(name, "1000000")
    try:
        assert most() <= 1_200_000
    finally:
        spark.conf.set(name, before)


def mapped_pages():
    """Process and mapped file of each worker, and the weights as they see them."""

    def model_fn(arrays):
        base = arrays[0]
        while not isinstance(base, np.memmap) or isinstance(base.base, np.memmap):
            base = base.base
        inode = os.stat(base.filename).st_ino
        total = float(sum(a.sum() for a in arrays))
        with open("/proc/self/maps") as maps:
            shared = sum(line.split()[4] == str(inode) for line in maps)
        return lambda batch: np.tile([os.getpid(), inode, shared, total], (len(batch), 1))

    return model_fn


def test_two_workers_map_one_file(spark):
    arrays = [np.arange(3_000_000, dtype=np.float32), np.ones((2, 3), np.int64), np.ones(5)[::2]]
    handle = weights.shared_weights(spark, arrays)
    assert isinstance(handle, weights.MappedWeights)
    assert weights.mapped_weights(spark, arrays).name == handle.name
    df = spark.range(0, 64, 1, 8).select("id", F.array(F.col("id").cast("double")).alias("v"))
    seen = [
        r.features
        for r in features.vector_features(
            df, "v", handle, mapped_pages(), element="double", keep=["id"]
        ).collect()
    ]
    assert len(seen) == 64
    assert len({r[0] for r in seen}) > 1
    assert len({r[1] for r in seen}) == 1 and all(r[2] >= 1 for r in seen)
    expected = float(sum(a.sum() for a in arrays))
    assert all(r[3] == expected for r in seen)


def test_small_weights_are_broadcast_and_odd_ones_refused(spark):
    small = weights.shared_weights(spark, [np.ones(3)])
    assert not isinstance(small, weights.MappedWeights) and small.value[0].sum() == 3
    assert weights.shared_weights(spark, small) is small
    assert weights.shared_weights(spark, {"a": 1}).value == {"a": 1}
    with pytest.raises(TypeError):
        weights.mapped_weights(spark, [np.array([object()])])
    with pytest.raises(ValueError):
        weights.mapped_weights(spark, [])
    empty = weights.mapped_weights(spark, [np.ones((0, 3)), np.ones((2, 2), np.int16)])
    assert [a.shape for a in empty.value] == [(0, 3), (2, 2)]
