"""Trees fitted from histograms against the library's own and against brute force."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.plans import training, trees
from farekit.session import even_parts, stage


@pytest.fixture(scope="module")
def tables(spark, data_dir):
    return training.training_tables(inputs.training_features(spark, data_dir), "fare_key")


def _predicted(model, rows, name):
    return model.transform(rows).select("fare_key", F.col("predicted_price").alias(name))


@pytest.mark.parametrize("rounds, alike", [(1, 0.998), (3, 0.98)])
def test_boosted_trees_are_those_of_the_library(tables, rounds, alike):
    """Without a draw of rows nothing is random. In nodes of few rows splits may have equal gains;
    rounding decides between them, in the library too, so a few rows may differ but not the error."""
    with even_parts(tables.train) as rows:
        pipeline = training.fare_pipeline("gbt", maxIter=rounds, subsamplingRate=1.0)
        ours, theirs = trees.fit_trees(pipeline, rows), pipeline.fit(rows)
    assert type(ours.stages[-1]) is type(theirs.stages[-1])
    assert ours.stages[-1].treeWeights == theirs.stages[-1].treeWeights
    assert ours.stages[-1].totalNumNodes == pytest.approx(theirs.stages[-1].totalNumNodes, abs=2 * (rounds - 1))
    both = _predicted(ours, tables.train, "ours").join(_predicted(theirs, tables.train, "theirs"), "fare_key").join(tables.train, "fare_key")
    off = lambda name: F.avg((F.col("price") - F.col(name)) ** 2)
    share, error, known = both.agg(F.avg((F.abs(F.col("ours") - F.col("theirs")) < 1e-6).cast("int")), off("ours"), off("theirs")).first()
    assert share >= alike and error == pytest.approx(known, rel=1e-9)
    set_in = lambda m: {p.name: v for p, v in m.stages[-1].extractParamMap().items()}
    assert set_in(ours) == set_in(theirs)
    assert ours.stages[-1]._java_obj.getMaxIter() == theirs.stages[-1]._java_obj.getMaxIter() == rounds


@pytest.mark.parametrize("preset, small", [("gbt", {"maxIter": 2}), ("rf", {"numTrees": 3, "maxDepth": 4})])
def test_fits_do_not_visit_every_slot(tables, monkeypatch, preset, small):
    """The library's fit, which adds every one-hot slot of every row, is not what is run."""

    def refuse(*_):
        raise AssertionError("fitted slot by slot")

    monkeypatch.setattr(GBTRegressor, "_fit", refuse)
    monkeypatch.setattr(RandomForestRegressor, "_fit", refuse)
    model = training.fit_fare_model(tables.train, preset, **small)
    assert model.transform(tables.held_out).where("predicted_price IS NULL").isEmpty()


def test_forest_is_as_good_as_the_library_s(tables):
    with even_parts(tables.train) as rows:
        pipeline = training.fare_pipeline("rf", numTrees=12, maxDepth=5)
        ours, theirs = trees.fit_trees(pipeline, rows), pipeline.fit(rows)
    assert ours.stages[-1].getNumTrees == theirs.stages[-1].getNumTrees == 12
    assert len({t.toDebugString for t in ours.stages[-1].trees}) == 12
    off = [m.transform(tables.held_out).agg(F.avg(F.abs(F.col("price") - F.col("predicted_price")))).first()[0] for m in (ours, theirs)]
    assert off[0] == pytest.approx(off[1], rel=0.15)


def test_bad_labels_are_refused(tables):
    for label in ("CAST('NaN' AS DOUBLE)", "CAST(NULL AS DOUBLE)"):
        with pytest.raises(Exception):
            training.fit_fare_model(tables.train.limit(20).withColumn("price", F.expr(label)), "gbt", maxIter=2)


def test_best_split_is_that_of_brute_force():
    rng = np.random.default_rng(3)
    columns = trees._columns([3], [np.array([0.5, 1.5])], np.ones(4))
    for _ in range(20):
        n = int(rng.integers(4, 40))
        codes, y = np.stack([rng.integers(0, 3, n), rng.integers(0, 3, n)]).astype(np.uint8), rng.random(n)
        tally, squares = np.zeros((3, 2, int(columns.starts[-1]))), np.zeros(2)
        trees._add(tally, squares, columns, np.zeros(n, dtype=np.int32), codes, y, None)
        found = trees.best_splits(columns, tally[:, :1], squares[:1], 2)[0]
        gains = []
        for column, low, high in zip(columns.column, columns.low, columns.high, strict=True):
            right = (codes[column] >= low) & (codes[column] <= high)
            few = min(right.sum(), n - right.sum()) < 2
            gains.append(-1 if few else y.var() - (y[right].var() * right.sum() + y[~right].var() * (n - right.sum())) / n)
        assert found[4] == pytest.approx(max(gains), abs=1e-12)
        assert found[3] == (np.argmax(gains) if max(gains) > 0 else -1) or gains[int(found[3])] == pytest.approx(max(gains), abs=1e-12)


def test_bins_hold_about_equal_numbers_of_rows():
    assert trees.bin_limits(np.array([1.0, 1.0, 2.0, 4.0]), 32).tolist() == [1.5, 3.0]
    limits = trees.bin_limits(np.arange(1000.0), 10)
    assert len(limits) == 9 and np.diff(np.searchsorted(np.arange(1000.0), limits)).tolist() == [100] * 8


def test_bundles_give_the_columns_histograms_whatever_depends_on_what():
    rng = np.random.default_rng(5)
    a, c = rng.integers(0, 4, 500), rng.integers(0, 30, 500)
    codes = np.stack([a, a // 2, c, rng.integers(0, 30, 500), rng.integers(0, 30, 500)]).astype(np.uint8)
    columns = trees._columns([3, 2], [np.arange(29.0)] * 3, np.ones(8))
    groups = trees.choose_groups(codes, columns, 8)
    assert (0, 1) in groups and sorted(j for group in groups for j in group) == list(range(5))
    keys = [np.unique(trees._joint(codes, group, columns)) if len(group) > 1 else None for group in groups]
    bundles = trees.Bundles.of(columns, groups, keys)
    node, y = rng.integers(0, 3, 500), rng.integers(-50, 50, 500).astype(float)
    plain, bundled, squares = np.zeros((2, 3, columns.starts[-1])), np.zeros((2, 3, bundles.starts[-1])), np.zeros(3)
    trees._add(plain, squares, columns, node, codes, y, None)
    trees._add(bundled, squares, bundles, node, bundles.encode(codes, columns), y, None)
    assert (bundles.by_column(bundled, columns) == plain).all()


def test_groups_with_too_many_combinations_fall_apart(tables, monkeypatch):
    """What the first blocks show need not hold for all rows; the trees are the same with any groups."""
    found, of = [], trees._bundles
    monkeypatch.setattr(trees, "_bundles", lambda *a: found.append(of(*a)) or found[-1])
    joined = training.fit_fare_model(tables.train, maxIter=2)
    monkeypatch.setattr(trees, "BUNDLE_CODES", 1)
    single = training.fit_fare_model(tables.train, maxIter=2)
    assert len(found[0].groups) < len(found[1].groups) == len(found[1].decoded)
    both = _predicted(joined, tables.held_out, "a").join(_predicted(single, tables.held_out, "b"), "fare_key")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-6).isEmpty()


def test_models_are_stored_as_the_library_stores_them(tables, tmp_path):
    """A model survives its own writer and reader, nodes included."""
    model = training.fit_fare_model(tables.train, maxIter=2).stages[-1]
    model.save(str(tmp_path / "model"))
    assert type(model).load(str(tmp_path / "model")).toDebugString == model.toDebugString


def test_forest_is_the_same_however_blocks_trees_and_nodes_are_put_together(tables, monkeypatch):
    models = [training.fit_fare_model(tables.train, "rf", numTrees=3, maxDepth=4)]
    for name in ("BLOCKS_TOGETHER", "TREES_TOGETHER", "NODES_TOGETHER"):
        monkeypatch.setattr(trees, name, 2)
    models.append(training.fit_fare_model(tables.train, "rf", numTrees=3, maxDepth=4))
    a, b = (_predicted(model, tables.held_out, name) for model, name in zip(models, "ab", strict=True))
    share = a.join(b, "fare_key").agg(F.avg((F.abs(F.col("a") - F.col("b")) < 1e-6).cast("int"))).first()[0]
    assert share >= 0.99


def test_fits_keep_no_copy_of_their_rows(tables, monkeypatch):
    """Rows are neither dealt out nor held whole: their codes alone are, once."""

    def refuse(*_):
        raise AssertionError("rows held whole")

    for module in (trees, training):
        monkeypatch.setattr(module, "even_parts", refuse, raising=False)
    seen = []
    stage = trees.stage
    monkeypatch.setattr(trees, "stage", lambda df, *a, **k: seen.append(df.columns) or stage(df, *a, **k))
    model = training.fit_fare_model(tables.train, maxIter=2)
    assert seen == [["part", "seq", "n", "codes", "labels", "hashes"]]
    assert model.transform(tables.held_out).where("predicted_price IS NULL").isEmpty()


def test_prepared_stages_are_the_library_s(tables):
    """Labels with nulls, equal counts and several lengths, and numbers with gaps, as the library's own fits have them."""
    gaps = {"airline": F.when(F.crc32("fare_key") % 5 > 0, F.col("airline")), "distance_km": F.when(F.crc32("fare_key") % 7 > 0, F.col("distance_km"))}
    rows = tables.train.limit(700).withColumns(gaps).localCheckpoint()
    *before, machine = training.fare_pipeline().getStages()
    ours, kept, n = trees._prepared(before, rows, F.col("price").cast("double"))
    theirs = Pipeline(stages=before).fit(rows).stages
    assert n == rows.where(kept).count() == Pipeline(stages=before).fit(rows).transform(rows).count() < 700
    assert ours[0].labelsArray == theirs[0].labelsArray and ours[1].categorySizes == theirs[1].categorySizes
    assert np.allclose(ours[3].std.toArray(), theirs[3].std.toArray(), rtol=1e-9, atol=1e-12)
    assert np.allclose(ours[3].mean.toArray(), theirs[3].mean.toArray(), rtol=1e-9, atol=1e-12)
    assert ours[0].transform(rows).exceptAll(theirs[0].transform(rows)).isEmpty()


def test_leaves_are_found_as_by_walking():
    rng = np.random.default_rng(7)
    columns = trees._columns([5, 3], [np.arange(20.0), np.arange(9.0)], np.ones(10))
    codes = np.stack([rng.integers(0, w, 3000) for w in columns.widths]).astype(np.uint8)
    keys = np.unique(trees._joint(codes, (0, 2), columns))
    bundles = trees.Bundles.of(columns, [(0, 2), (1,), (3,)], [keys, None, None])
    for depth in (1, 3, 6, 8):
        tree = trees.Tree()
        for level in range(depth):
            found = np.zeros((len(tree.open), 8))
            found[:, 3] = rng.integers(-1 if level else 0, len(columns.slot), len(tree.open))
            tree.grow(columns, found, level == depth - 1)
        numbers = np.arange(len(tree.child))
        walked = trees._walk(trees._steps(tree, numbers, bundles, numbers), depth, bundles.encode(codes, columns))
        assert (trees._targets(tree, bundles, numbers)(bundles.encode(codes, columns)) == walked).all()


def test_draws_follow_the_row_and_have_their_law():
    hashes = np.random.default_rng(9).integers(0, 2**32, 200_000, dtype=np.uint32)
    turns = [trees._mixed(hashes, trees._salt(42, turn)) < np.uint32(0.8 * 2**32) for turn in (3, 4)]
    assert [t.mean() for t in turns] == pytest.approx([0.8, 0.8], abs=0.005) and (turns[0] & turns[1]).mean() == pytest.approx(0.64, abs=0.005)
    order = np.argsort(hashes)
    assert (trees._mixed(hashes[order], trees._salt(42, 3)) == trees._mixed(hashes, trees._salt(42, 3))[order]).all()
    drawn = trees._poisson(1.0, trees._mixed(hashes, trees._salt(42, 5)))
    assert drawn.mean() == pytest.approx(1, abs=0.01) and drawn.var() == pytest.approx(1, abs=0.02) and (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)


def test_staging_leaves_no_shuffle_behind(spark):
    """What made a staged table is gone once it is written, and the setting is as before."""
    files = lambda: set(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|").split("|"))
    shuffled = lambda: {f for f in files() if "shuffle_" in f}
    before, setting = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    staged = stage(spark.range(100_000).repartition(4, "id"), "shuffled")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and staged.count() == 100_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_residuals_taken_anew_are_the_same(tables, monkeypatch):
    models = [training.fit_fare_model(tables.train, maxIter=5)]
    monkeypatch.setattr(trees, "FRESH_ROUNDS", 2)
    models.append(training.fit_fare_model(tables.train, maxIter=5))
    a, b = (_predicted(model, tables.held_out, name) for model, name in zip(models, "ab", strict=True))
    assert a.join(b, "fare_key").where(F.abs(F.col("a") - F.col("b")) > 1e-6).isEmpty()
