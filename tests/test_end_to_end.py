"""From a folder of images to a checked feature table, and the inspection calls."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from __spark_entry__ import queries
from images import LABELS, draw_tree
from tessera import sinks, sources
from tessera.operators import features, profile, sampling

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    return draw_tree(spark, tmp_path_factory.mktemp("images"), per_label=6)


def test_sample_of_images_keeps_their_bytes(spark, tree, tmp_path):
    images = sources.labelled_images(spark, str(tree))
    counts = {r.label: r.n for r in sampling.class_counts(images).collect()}
    assert counts == {LABELS[0]: 6, LABELS[1]: 7, LABELS[2]: 6}
    sample = sampling.sample_images(spark, str(tree), 7)
    assert sample.rows.columns == images.columns
    plan = {r.label: r.quota for r in sample.plan.collect()}
    assert sum(plan.values()) == 7
    sinks.write_by_label(sample.rows, str(tmp_path / "sample"))
    stored = sinks.read_by_label(spark, str(tmp_path / "sample")).collect()
    assert Counter(r.label for r in stored) == plan
    for row in stored:
        name = row.path.removeprefix("file:")
        assert open(name, "rb").read() == bytes(row.content)
        assert name.split("/")[-2] == row.label
    assert sampling.sample_images(spark, str(tree), 0).rows.count() == 0
    with pytest.raises(ValueError):
        sampling.sample_images(spark, str(tree), 20)


def test_features_of_a_folder(spark, tree, tmp_path):
    decoded = sources.decode_images(spark, str(tree))
    table = features.image_features(decoded, features.pooled_weights(), on_error="drop")
    sinks.write_parquet(table, str(tmp_path / "features"))
    stored = sources.read_parquet(spark, str(tmp_path / "features"))
    assert profile.vector_length_check(stored, "features", 1280).collect() == [(18, 1280, 1280, 0)]
    vectors = np.stack(stored.orderBy("path").toPandas()["features"].to_numpy())
    assert vectors.shape == (18, 1280)
    assert len(np.unique(vectors.round(4), axis=0)) == 18


def test_inspection_calls(spark, capsys):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    assert orders.columns == orders.schema.names == [name for name, _ in orders.dtypes]
    assert orders.first() == orders.head(1)[0] == orders.take(1)[0]
    assert len(orders.head(3)) == 3
    orders.show(2, truncate=False)
    orders.printSchema()
    printed = capsys.readouterr().out
    assert "o_orderkey" in printed and "nullable" in printed
    described = orders.select("o_totalprice", "o_orderstatus").describe()
    assert [t for _, t in described.dtypes] == ["string"] * 3


def test_no_query_pairs_all_rows(spark):
    for name, query in queries().items():
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "NestedLoop" not in plan, name


def test_predicates_and_columns_reach_the_scan(spark):
    plan = queries()["filter_date_range"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThanOrEqual(l_shipda" in pushed
    assert "l_quantity" not in plan.split("ReadSchema:")[1]
    filtered = queries()["exclude_values"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert filtered.index("Filter") > filtered.rindex("HashAggregate")
