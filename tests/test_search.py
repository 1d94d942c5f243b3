"""Boosting on the binned layout, nested grids, the shared table of out-of-fold scores."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.models import search, stumps, zoo
from cohortwise.models.frame import FOLD, LABEL


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.integers(0, 6, 300), rng.integers(0, 2, 300), rng.normal(size=300).round(2)]).astype(float)
    y = ((x[:, 0] > 2).astype(int) ^ ((x[:, 1] == 1) & (rng.random(300) < 0.4)) ^ (rng.random(300) < 0.1)).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label int")
    return search.folded_frame(df, ["a", "b", "c"], "label", "id", 4)


def plain_boosting(x, y, edges, rounds, rate):
    """Row by row, with the same choice among ties."""
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for f, cuts in enumerate(edges):
            for edge in cuts:
                left = x[:, f] <= edge
                gain, err, votes = 0.0, 0.0, []
                for side in (left, ~left):
                    zero, one = w[side & (y == 0)].sum(), w[side & (y == 1)].sum()
                    gain += (zero**2 + one**2) / (zero + one) if zero + one else 0.0
                    votes.append(int(one > zero))
                    err += min(zero, one)
                if not left.any() or left.all():
                    continue
                if best is None or round(gain / w.sum(), 9) > best[0]:
                    best = (round(gain / w.sum(), 9), f, edge, *votes, err / w.sum())
        _, f, edge, a, b, err = best
        if err >= 0.5:
            break
        alpha = rate * math.log((1 - err) / err)
        out.append((f, edge, a, b, alpha))
        miss = np.where(x[:, f] <= edge, a, b) != y
        w = w * np.exp(alpha * miss)
    return out


@pytest.mark.parametrize("rate", [1.0, 0.3])
def test_boosting_equals_a_plain_loop(frame, rate):
    pdf = frame.toPandas()
    x, y = np.stack(pdf["values"]), pdf[LABEL].to_numpy()
    model = zoo.fit(zoo.ModelSpec("ada", "ada_boost", {"rounds": 30, "learning_rate": rate}), frame)
    want = plain_boosting(x, y, stumps.bin_edges(frame), 30, rate)
    got = [(*s, a) for s, a in zip(model.run.stumps, model.run.alphas)]
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4])


def test_bins_are_exact(frame):
    edges = stumps.bin_edges(frame)
    assert edges[0] == [0.5, 1.5, 2.5, 3.5, 4.5] and edges[1] == [0.5] and 20 < len(edges[2]) < stumps.BINS
    cells = stumps.cells_of(frame, edges)
    assert cells.agg(F.sum("n")).first()[0] == 300 and cells.count() < 300 + 1
    for r in frame.limit(20).collect():
        b = [sum(v > e for e in es) for v, es in zip(r["values"], edges)]
        assert cells.filter((F.col("bins") == F.lit(b)) & (F.col("label") == r[LABEL])).count() >= 1


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("counted", "counted")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before


def test_a_hundred_rounds_take_few_jobs(spark, frame):
    edges = stumps.bin_edges(frame)
    cells, run = stumps.cells_of(frame, edges), stumps.Run(0.1)
    # Adaptive planning runs the two stages of a grouped sum as two jobs.
    assert jobs_of(spark, lambda: stumps.fit_runs(cells, edges, [run], 100)) <= 2 * 120
    assert len(run.stumps) == 100


def test_runs_side_by_side_equal_runs_alone(frame):
    spec = zoo.ModelSpec("ada", "ada_boost", {"rounds": 12})
    together = zoo.fit_ada_runs(spec, frame, [(1.0, None), (0.5, 2), (1.0, 0)])
    assert together[0].run.alphas == pytest.approx(zoo.fit(spec, frame).run.alphas)
    edges = stumps.bin_edges(frame)
    part = frame.filter(F.col(FOLD) != 2)
    alone = stumps.Run(0.5)
    stumps.fit_runs(stumps.cells_of(part, edges), edges, [alone], 12)
    assert together[1].run.stumps == alone.stumps and together[1].run.alphas == pytest.approx(alone.alphas)


GRIDS = [
    (zoo.ModelSpec("ada", "ada_boost", {"rounds": 10}), {"rounds": [3, 6, 12], "learning_rate": [0.1, 1.0]}),
    (zoo.ModelSpec("tree", "tree", {"maxDepth": 4}), {"maxDepth": [1, 2, 5], "minInstancesPerNode": [1, 5]}),
    (zoo.ModelSpec("knn", "nearest", {"k": 7}), {"k": [3, 5, 9], "weights": ["uniform", "distance"]}),
    (zoo.ModelSpec("gbt", "boosted_trees", {"maxDepth": 2}), {"maxIter": [2, 5, 8], "stepSize": [0.1, 0.5]}),
    (zoo.ModelSpec("lr", "logistic", {"maxIter": 20}), {"C": [0.1, 10.0]}),
    (zoo.ModelSpec("linear", "svc", {"maxIter": 10, "kernel": "linear"}), {"C": [0.1, 1.0], "gamma": ["scale", "auto"]}),
]


@pytest.mark.parametrize("spec, grid", GRIDS, ids=lambda x: getattr(x, "name", ""))
def test_nested_grid_equals_point_by_point(frame, spec, grid):
    options = search.combinations(grid)
    means, fits = search.chain_means(spec, frame, options, 4)
    if spec.kind == "ada_boost":  # edges are taken from all rows, as the search does
        edges = stumps.bin_edges(frame)
        cells = stumps.cells_of(frame, edges)
        apart = []
        for o in options:
            runs = [stumps.Run(o["learning_rate"], f) for f in range(4)]
            apart.append(statistics.fmean(stumps.fit_runs(cells, edges, runs, o["rounds"], [o["rounds"]])[o["rounds"]]))
            if o["rounds"] == 6:
                right = sum(search.accuracy(zoo.StumpsFitted(spec, r).score(frame.filter(F.col(FOLD) == r.held_out))) for r in runs) / 4
                assert right == pytest.approx(apart[-1])
    else:
        apart = [statistics.fmean(search.cross_validate(spec.with_params(**o), frame, 4)) for o in options]
    assert means == pytest.approx(apart)
    assert fits < 4 * len(options) or spec.kind == "logistic"


def test_a_forest_is_cut_to_its_first_trees(frame):
    model = zoo.fit(zoo.ModelSpec("forest", "random_forest", {"numTrees": 6, "maxDepth": 3}), frame)
    few = model.first(2)
    assert len(few.model.trees) == 2 and few.spec.params["numTrees"] == 2
    both = few.score(frame).select("id", "prob").collect()
    alone = [t.transform(frame).select("id", F.element_at(zoo.vector_to_array("probability"), 2).alias("p")).collect() for t in model.model.trees[:2]]
    mean = {a["id"]: (a["p"] + b["p"]) / 2 for a, b in zip(*(sorted(x, key=lambda r: r["id"]) for x in alone))}
    assert all(r["prob"] == pytest.approx(mean[r["id"]]) for r in both)


def test_declared_grids_need_fewer_fits():
    points = fits = 0
    for spec in zoo.BASE_MODELS:
        if spec.name in search.WIDE_GRIDS:
            options = search.combinations(search.WIDE_GRIDS[spec.name])
            points += len(options)
            # The rates of boosted one-split trees are one run.
            fits += 1 if spec.kind == "ada_boost" else len(search.chains(spec, options))
    assert fits <= 0.36 * points


def test_one_table_of_scores_serves_all(frame):
    specs = [zoo.ModelSpec("lr", "logistic", {"maxIter": 20}), zoo.ModelSpec("tree", "tree", {"maxDepth": 3}), zoo.ModelSpec("ada", "ada_boost", {"rounds": 5})]
    scores = search.out_of_fold(specs, frame, 4)
    assert scores.count() == 300 and not {"lr", "tree", "ada", "id", FOLD, LABEL} - set(scores.columns)
    found = search.fold_accuracies(scores, ["lr", "tree"], 4)
    one = zoo.fit(specs[1], frame.filter(F.col(FOLD) != 2))
    assert found["tree"][2] == pytest.approx(search.accuracy(one.score(frame.filter(F.col(FOLD) == 2))))
    stacked = search.fit_stacked("s", specs, specs[0], frame, "id", 4, scores)
    assert list(stacked.bases) == ["lr", "tree", "ada"] and search.accuracy(stacked.score(frame)) > 0.7
    assert len(search.ensemble_cv(specs, specs[0], frame, 4, scores)["voting"]) == 4


def brute_near(points, probe, k):
    rows = sorted((round(sum((a - b) ** 2 for a, b in zip(p, probe)), 9), p) for p in points)
    return rows[:k]


@pytest.mark.parametrize("pivots, block", [(1, 20_000), (9, 40), (64, 7)])
def test_neighbour_join_equals_brute_force(spark, monkeypatch, pivots, block):
    from cohortwise.models import neighbours

    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(5)
    points = {tuple(p) for p in rng.integers(0, 6, (250, 3)).astype(float).tolist()} | {tuple(p) for p in rng.normal(3, 1, (150, 3)).round(3).tolist()}
    probes = list(points)[:60] + [tuple(p) for p in rng.normal(3, 4, (60, 3)).round(3).tolist()] + [(99.0, 99.0, 99.0)]
    left = spark.createDataFrame([(list(p), 1.0, 0.0) for p in points], "values array<double>, n double, y double")
    right = spark.createDataFrame([(list(p),) for p in probes + probes[:5]], "values array<double>")
    got = {tuple(r["values"]): [(x["d2"], tuple(x["point"])) for x in r["near"]] for r in neighbours.neighbours(left, right, 5, pivots).collect()}
    assert got.keys() == set(probes)
    for probe in got:
        assert got[probe] == brute_near(points, probe, 5), probe


def test_neighbour_join_has_few_points(spark):
    from cohortwise.models import neighbours

    left = spark.createDataFrame([([1.0, 2.0], 3.0, 1.0)], "values array<double>, n double, y double")
    right = spark.createDataFrame([([0.0, 0.0],)], "values array<double>")
    assert [x["d2"] for x in neighbours.neighbours(left, right, 5).first()["near"]] == [5.0]
    assert neighbours.neighbours(left.limit(0), right, 5).count() == 0
    assert neighbours.neighbours(left, right.limit(0), 5).count() == 0


def test_bayes_of_a_fold_is_fitted_on_the_others(frame):
    from cohortwise.models import bayes

    pdf = frame.toPandas()
    for fold, found in zip([None, 0, 3], bayes.fit(frame, [None, 0, 3])):
        kept = pdf if fold is None else pdf[pdf[FOLD] != fold]
        for y in (0, 1):
            x = np.stack(kept[kept[LABEL] == y]["values"])
            smoothing = 1e-9 * np.stack(kept["values"]).var(axis=0).max()
            assert found.rows[y] == len(x) and found.means[y] == pytest.approx(x.mean(axis=0)) and found.variances[y] == pytest.approx(x.var(axis=0) + smoothing)


def plain_tree(x, y, tree, depth, min_split, seed):
    """One extremely randomised tree over rows, with the same draws."""
    from cohortwise.models import extra

    width = x.shape[1]
    out = extra.Tree({}, {}, {})

    def grow(node, at, level):
        zero, one = int((y[at] == 0).sum()), int((y[at] == 1).sum())
        out.feature[node], out.share[node] = -1, one / (zero + one)
        low, high = x[at].min(axis=0), x[at].max(axis=0)
        order = np.argsort(extra.draw(seed, tree, node, np.arange(width)), kind="stable")
        kept = sorted([f for f in order if low[f] < high[f]][: math.ceil(math.sqrt(width))])
        if not zero or not one or zero + one < min_split or level == depth or not kept:
            return
        best = None
        for f, u in zip(kept, extra.draw(seed + 1, tree, node, np.array(kept))):
            cut = float(low[f] + u * (high[f] - low[f]))
            left = at[x[at, f] <= cut]
            ones = int(y[left].sum())
            gain = extra.purity((len(left) - ones, ones), (zero, one))
            if best is None or gain > best[0] + 1e-12:
                best = (gain, int(f), cut)
        _, f, cut = best
        out.feature[node], out.threshold[node] = f, cut
        grow(2 * node, at[x[at, f] <= cut], level + 1)
        grow(2 * node + 1, at[x[at, f] > cut], level + 1)

    grow(1, np.arange(len(x)), 0)
    return out


def test_extra_trees_equal_plain_trees(frame):
    from cohortwise.models import extra

    pdf = frame.toPandas()
    x, y, folds = np.stack(pdf["values"]), pdf[LABEL].to_numpy(), pdf[FOLD].to_numpy()
    grown = extra.grow(frame.repartition(5), 3, 4, [None, 1], 4)
    for held_out, trees in zip([None, 1], grown):
        kept = folds != (-2 if held_out is None else held_out)
        for i, tree in enumerate(trees):
            want = plain_tree(x[kept], y[kept], i, 4, 4, extra.SEED)
            assert tree.feature == want.feature and tree.share == pytest.approx(want.share)
            assert {n: t for n, t in tree.threshold.items()} == pytest.approx(want.threshold)


def test_extra_trees_differ_and_predict(frame):
    spec = zoo.ModelSpec("extra", "extra_trees", {"numTrees": 30, "maxDepth": 6})
    model = zoo.fit(spec, frame.filter(F.col(FOLD) != 0))
    assert len({tuple(sorted(t.feature.items())) for t in model.trees}) > 20
    assert search.accuracy(model.score(frame.filter(F.col(FOLD) == 0))) > 0.6
    means, fits = search.chain_means(spec, frame, [{"numTrees": 5}, {"numTrees": 30}], 4)
    assert fits == 4 and means[1] == pytest.approx(statistics.fmean(search.cross_validate(spec, frame, 4)))


def test_a_random_search_draws(frame):
    models = zoo.fit_all([zoo.ModelSpec("DecisionTree", "tree", {"maxDepth": 4})], frame)
    grid = {"DecisionTree": {"maxDepth": [1, 2, 5, 8], "minSplit": [2, 20, 60]}}
    every = search.combinations(grid["DecisionTree"])
    drawn = [r["params"] for r in search.tune(models, frame, grid, 4, n_iter=5)[1].collect()]
    assert len(set(drawn)) == 5 and set(drawn) < {str(o) for o in every}
    # A grid that is no larger than the draws is drawn too.
    whole = [r["params"] for r in search.tune(models, frame, grid, 4, n_iter=50)[1].collect()]
    assert sorted(whole) == sorted(map(str, every)) and whole != list(map(str, every))


def test_the_random_search_has_more_points_than_draws():
    sizes = {n: len(search.combinations(g)) for n, g in search.RANDOM_GRIDS.items()}
    assert sizes == {"DecisionTree": 160, "KNN": 30}


def test_smallest_nodes_to_split_come_from_one_fit(frame):
    spec = zoo.ModelSpec("tree", "tree", {"maxDepth": 4})
    options = search.combinations({"maxDepth": [2, 6], "minSplit": [2, 10, 40]})
    means, fits = search.chain_means(spec, frame, options, 4)
    assert fits == 4 and len(set(means)) > 2
    assert means == pytest.approx([statistics.fmean(search.cross_validate(spec.with_params(**o), frame, 4)) for o in options])
    nodes = zoo.tree_nodes(frame.sparkSession, zoo.fit(spec.with_params(maxDepth=6, minSplit=40), frame).model)
    whole = zoo.tree_nodes(frame.sparkSession, zoo.fit(spec.with_params(maxDepth=6), frame).model)
    assert (nodes[5][nodes[0] >= 0] >= 40).all() and len(nodes[0]) < len(whole[0]) and nodes[1][0] == whole[1][0]


@pytest.mark.parametrize("pivots, block", [(1, 20_000), (9, 40), (64, 7)])
def test_neighbours_by_manhattan_distance_equal_brute_force(spark, monkeypatch, pivots, block):
    from cohortwise.models import neighbours

    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(6)
    points = {tuple(p) for p in rng.integers(0, 6, (250, 3)).astype(float).tolist()} | {tuple(p) for p in rng.normal(3, 1, (150, 3)).round(3).tolist()}
    probes = list(points)[:60] + [tuple(p) for p in rng.normal(3, 4, (60, 3)).round(3).tolist()] + [(99.0, 99.0, 99.0)]
    left = spark.createDataFrame([(list(p), 1.0, 0.0) for p in points], "values array<double>, n double, y double")
    right = spark.createDataFrame([(list(p),) for p in probes], "values array<double>")
    got = {tuple(r["values"]): [(x["d2"], tuple(x["point"])) for x in r["near"]] for r in neighbours.neighbours(left, right, 5, pivots, p=1).collect()}
    for probe in probes:
        want = sorted((round(sum(abs(a - b) for a, b in zip(p, probe)) ** 2, 9), p) for p in points)[:5]
        assert [d for d, _ in got[probe]] == pytest.approx([d for d, _ in want])


def test_both_metrics_are_searched_where_points_are_joined(frame):
    spec = zoo.ModelSpec("KNN", "nearest", {"k": 5, "weights": "uniform"})
    options = search.combinations({"k": [3, 5], "metric": ["euclidean", "manhattan", "minkowski"]})
    joined, fits = search.chain_means(spec.with_params(fit_points=0), frame, options, 4)
    assert fits == 8 and joined == pytest.approx(search.chain_means(spec, frame, options, 4)[0], abs=0.02)
    assert joined[0] == joined[2] and joined[3] == joined[5]


def test_stumps_are_the_same_in_one_task_and_dealt(frame, monkeypatch):
    edges, rounds = stumps.bin_edges(frame), []
    cells, real = stumps.cells_of(frame, edges), stumps._round

    def boosted():
        runs = [stumps.Run(1.0), stumps.Run(0.3, 1), stumps.Run(0.7, 3)]
        return runs, stumps.fit_runs(cells, edges, runs, 12, [4, 12])

    monkeypatch.setattr(stumps, "_round", lambda *a: rounds.append(1) or real(*a))
    here, marks = boosted()
    assert not rounds
    monkeypatch.setattr(stumps, "LOCAL", 0)
    dealt, again = boosted()
    assert len(rounds) == 12 and marks.keys() == again.keys()
    for a, b in zip(here, dealt):
        assert a.stumps == b.stumps and a.alphas == pytest.approx(b.alphas) and a.errors == pytest.approx(b.errors) and a.open == b.open
    for stage in marks:
        assert marks[stage][0] is None and marks[stage][1:] == pytest.approx(again[stage][1:])
