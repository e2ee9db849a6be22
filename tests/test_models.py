"""Invariants of the model operators (fits have no SQL oracle)."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import anomaly as an
from quarry.operators import cluster as cu
from quarry.operators import outlier as ol


def _blobs(spark, n=200, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.normal(0, 0.3, size=(n, 3))
    b = rng.normal(5, 0.3, size=(n, 3))
    rows = [(i, [float(v) for v in x], 0) for i, x in enumerate(a)] + \
           [(n + i, [float(v) for v in x], 1) for i, x in enumerate(b)]
    return spark.createDataFrame(rows, "id long, v array<double>, truth int")


def test_kmeans_separates_blobs(spark):
    v = cu.vectorise(_blobs(spark))
    a = cu.assign(cu.kmeans_best(v, 2, n_init=2), v, ["id", "truth"])
    pairs = {(r["truth"], r["cluster"]) for r in a.collect()}
    assert len(pairs) == 2


def test_select_k_prefers_two(spark):
    v = cu.vectorise(_blobs(spark))
    s = {r["k"]: r for r in cu.select_k(v, [2, 3, 4], n_init=1).collect()}
    assert s[2]["best"] and s[2]["silhouette"] > 0.8
    assert s[2]["inertia"] >= s[3]["inertia"] >= s[4]["inertia"] * 0.999


def test_ward_on_centroids_two_groups():
    c = np.array([[0.0], [0.1], [0.2], [10.0], [10.1]])
    lab = cu.ward_on_centroids(c, np.ones(5), 2)
    assert list(lab) == [0, 0, 0, 1, 1]


def test_ward_merge_1d():
    assert np.allclose(ol.ward_merge_1d([1.0, 1.2, 5.0]), [1.1, 5.0])


def test_iforest_ranks_outliers_high(spark):
    rng = np.random.default_rng(0)
    pts = [(i, [float(x), float(y)]) for i, (x, y) in enumerate(rng.normal(0, 1, size=(500, 2)))]
    pts += [(1000 + i, [20.0 + i, -20.0]) for i in range(5)]
    df = spark.createDataFrame(pts, "id long, x array<double>")
    r = an.iforest(df, "x", ["id"], contamination=0.01, n_trees=50)
    flagged = {row["id"] for row in r.where("label = -1").collect()}
    assert {1000, 1001, 1002, 1003, 1004} <= flagged
    assert len(flagged) <= 7


def test_ocsvm_flag_share(spark):
    rng = np.random.default_rng(2)
    pts = [(i, [float(x), float(y)]) for i, (x, y) in enumerate(rng.normal(0, 1, size=(400, 2)))]
    df = spark.createDataFrame(pts, "id long, x array<double>")
    r = an.ocsvm(df, "x", 2, ["id"], nu=0.05)
    share = r.where("label = -1").count() / 400
    assert 0.03 <= share <= 0.07


def test_kde_bands_flag_rare_decade(spark):
    rng = np.random.default_rng(5)
    vals = list(rng.uniform(1000, 5000, size=2000)) + [3_000_000.0 + i for i in range(5)]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "rid long, price double")
    lv = ol.log_values(df, "rid", ["price"])
    fl = ol.flagged_cells(lv, ol.scale_bands(lv))
    assert {r["rid"] for r in fl.collect()} == set(range(2000, 2005))


def test_pca_signs_reproducible(spark):
    v = cu.vectorise(_blobs(spark).withColumn("v", F.col("v")))
    a = {r["id"]: r["pc1"] for r in cu.pca_2d(v, ["id"]).collect()}
    b = {r["id"]: r["pc1"] for r in cu.pca_2d(v, ["id"]).collect()}
    assert a == b


def test_values_of_a_column_stay_where_they_are_for_the_bands(spark):
    """Bands go to the values: no shuffle join brings a column to one task."""
    from quarry.operators import outlier as ol
    rows = [(i, 10.0 + i % 7 + (1e6 if i % 500 == 0 else 0)) for i in range(1000)]
    lv = ol.log_values(spark.createDataFrame(rows, "id long, price double"), "id", ["price"])
    bands = spark.createDataFrame([("price", 0, 0.5, 2.0), ("price", 1, 5.0, 9.0)], ol.BANDS_SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = ol.flagged_cells(lv, bands)
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r["id"] for r in flagged.collect()} == {0, 500}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kmeans_fits_equal_single_fits(spark, monkeypatch):
    """All restarts of every k go round together, in a gang or a job a round,
    and end where Spark's own fit of each ends."""
    from pyspark.ml.clustering import KMeans
    v = cu.vectorise(_blobs(spark, 60, 3))
    single = {k: min((m.summary.trainingCost, s, m.clusterCenters()) for s in (42, 43)
                     for m in [KMeans(k=k, seed=s, maxIter=300, tol=1e-2).fit(v)])[2] for k in (2, 4)}
    for room in (cu.GANG_BYTES, 0):
        monkeypatch.setattr(cu, "GANG_BYTES", room)
        fits = cu.kmeans_fits(v, [2, 4], n_init=2)
        for k, centres in single.items():
            assert np.allclose(fits[k].clusterCenters(), centres, atol=1e-9)


def test_kmeans_takes_no_job_per_round_and_restart(spark):
    """After the starts, restarts cost no jobs of their own."""
    v = cu.vectorise(_blobs(spark, 60, 3))
    rows, starts = v.select("v"), {i: np.array([[0.0] * 3, [1.0 + i] * 3]) for i in range(5)}
    spark.sparkContext.setJobGroup("rounds", "rounds")
    cu._rounds_in_jobs(rows, fits := cu._Lloyd(starts, 1e-2), 300)
    rounds = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not fits.active and rounds <= 12
    assert np.allclose([c.mean(axis=1).min() for c in fits.centres.values()], 0, atol=0.2)


def _grouped_points(spark, sizes=((2, 300), (3, 200), (5, 60))):
    """(id, g, x): per group ``g`` so many points of ``g`` components, two of each far off."""
    rng = np.random.default_rng(9)
    rows = [(i, d, [float(v) for v in (rng.normal(0, 1, d) if i >= 2 else np.full(d, 15.0 + i))])
            for d, n in sizes for i in range(n)]
    return spark.createDataFrame(rows, "id long, g int, x array<double>")


def test_models_of_groups_equal_their_single_fits(spark, monkeypatch):
    """Groups fitted together end where each ends alone, in a gang or a job a step."""
    df = _grouped_points(spark)
    svm, forest = {}, {}
    for g in (2, 3, 5):
        own = df.where(F.col("g") == g)
        svm |= {(r["id"], g): (r["score"], r["label"]) for r in an.ocsvm(own, "x", g, ["id", "g"]).collect()}
        forest |= {(r["id"], g): (r["score"], r["label"]) for r in an.iforest(own, "x", ["id", "g"]).collect()}
    both = an.iforest(df, "x", ["id", "g"], by=["g"])
    assert {(r["id"], r["g"]): (r["score"], r["label"]) for r in both.collect()} == forest
    for room in (an.GANG_BYTES, 0):
        monkeypatch.setattr(an, "GANG_BYTES", room)
        rows = an.ocsvm(df, "x", {(g,): g for g in (2, 3, 5)}, ["id", "g"], by=["g"]).collect()
        assert len(rows) == len(svm) and all(r["label"] == svm[r["id"], r["g"]][1] for r in rows)
        assert np.allclose([r["score"] for r in rows], [svm[r["id"], r["g"]][0] for r in rows], atol=1e-9)


def test_ocsvm_matches_steps_by_hand(spark):
    """The fit's scores are those of plain full-batch subgradient steps."""
    df = _grouped_points(spark, ((2, 300),))
    x = np.array([r["x"] for r in df.orderBy("id").collect()])
    w_, b_ = an.rff_draw(2, 100, 1.0 / (2 * x.var()), 42)
    z, w, rho, best, history = an.rff(x, w_, b_), np.full(100, 0.1), 0.0, (np.inf, None), []
    for t in range(501):
        gap = rho - z @ w
        best = min(best, (w @ w / 2 + gap[gap > 0].sum() / 15 - rho, w), key=lambda b: b[0])
        history.append(best[0])
        if t >= 10 and history[-11] - history[-1] <= 1e-3 * max(abs(history[-1]), 1e-3):
            break
        w, rho = (w - (w - z[gap > 0].sum(axis=0) / 15) / (t + 2), rho - ((gap > 0).sum() / 15 - 1) / (t + 2))
    s = z @ best[1]
    got = {r["id"]: r["score"] for r in an.ocsvm(df, "x", 2, ["id"], nu=0.05).collect()}
    assert np.allclose([got[i] for i in range(300)], s - np.quantile(s, 0.05), atol=1e-9)


def test_ocsvm_takes_no_job_per_step(spark):
    """However many steps and groups, the fits share a bounded number of jobs."""
    df = _grouped_points(spark).cache()
    df.count()

    def jobs(name, fit):
        spark.sparkContext.setJobGroup(name, name)
        fit()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    one = jobs("one", lambda: an.ocsvm(df.where("g = 2"), "x", 2, ["id"]))
    # adaptive execution may run a shuffle more or less as a job of its own
    assert one <= 24
    assert jobs("all", lambda: an.ocsvm(df, "x", {(g,): g for g in (2, 3, 5)}, ["id", "g"], by=["g"])) <= one + 4


def test_zscore_array_by_equals_each_group_alone(spark):
    from quarry.operators.encode import zscore_array, zscore_array_by
    df = _grouped_points(spark).unionByName(spark.createDataFrame([(0, 1, [7.0]), (1, 1, [7.0])], "id long, g int, x array<double>"))
    got = {(r["g"], r["id"]): r["z"] for r in zscore_array_by(df, "x", ["g"], "z").collect()}
    for g in (1, 2, 3, 5):
        for r in zscore_array(df.where(F.col("g") == g), "x", g, "z").collect():
            assert np.allclose(got[g, r["id"]], r["z"], atol=1e-12)


def test_few_parts_keeps_rows_and_follows_their_number(spark):
    from quarry.session import cut_lineage, few_parts
    df = cut_lineage(spark.range(0, 1000, 1, 200))
    few = spark.sparkContext.defaultParallelism
    assert few_parts(df).rdd.getNumPartitions() == min(200, few)
    assert few_parts(df, rows=10).rdd.getNumPartitions() == min(200, max(few, 100))
    assert sorted(r[0] for r in few_parts(df).collect()) == list(range(1000))
