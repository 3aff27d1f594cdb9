import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import ease
from tandem.operators.vectors import pair_dot, topk_inner_product
from tests.conftest import rows


def test_ease_micro_weights(likes):
    model = ease.fit(likes, top_k_items=2, l2_reg=1.0, tile=1)
    w = {(r.item_i, r.item_j): r.w for r in model.weights_long(likes.sparkSession).collect()}
    assert w[(10, 20)] == pytest.approx(0.5, abs=1e-9)
    assert w[(20, 10)] == pytest.approx(1.0, abs=1e-9)
    assert all(r.ok for r in ease.residual_check(model).collect())


def _planted(spark, n_users=120, n_items=60, blocks=3, seed=0):
    rng = np.random.default_rng(seed)
    data, per = [], n_items // blocks
    for u in range(n_users):
        b = u % blocks
        for _ in range(12):
            inside = rng.random() < 0.9
            blk = b if inside else rng.integers(blocks)
            data.append((u, int(blk * per + rng.integers(per)), int(rng.integers(1000)), 1))
    return spark.createDataFrame(data, "uid long, item_id long, timestamp long, is_organic int"), data


def test_ease_matches_numpy_inverse(spark):
    df, data = _planted(spark)
    model = ease.fit(df, top_k_items=1000, l2_reg=5.0, tile=16)
    items = sorted({i for _, i, _, _ in data})
    pos = {it: k for k, it in enumerate(items)}
    X = np.zeros((120, len(items)))
    for u, i, _, _ in data:
        X[u, pos[i]] += 1
    P = np.linalg.inv(X.T @ X + 5.0 * np.eye(len(items)))
    B = P / -np.diag(P)
    np.fill_diagonal(B, 0.0)
    got = np.zeros_like(B)
    for r in model.weights_long(spark).collect():
        got[pos[r.item_i], pos[r.item_j]] = r.w
    assert np.abs(got - B).max() < 1e-9
    users = spark.createDataFrame([(u,) for u in range(120)], "uid long")
    top = ease.score(model, df, users, 5, user_block_rows=17)
    S = X @ B
    want = {(u, items[j]) for u in range(120) for j in np.argsort(-S[u], kind="stable")[:5]}
    assert {(r.uid, r.item_id) for r in top.collect()} == want


def test_vector_topk_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    q = rng.normal(size=(37, 8)).astype(np.float32)
    it = rng.normal(size=(101, 8)).astype(np.float32)
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, features array<float>")
    idf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(it)], "id long, features array<float>")
    out = topk_inner_product(qdf, idf, 7, query_block_rows=10, item_block_rows=23)
    S = q.astype(np.float64) @ it.astype(np.float64).T
    want = {(a, int(b)) for a in range(37) for b in np.argsort(-S[a], kind="stable")[:7]}
    assert {(r.qid, r.item_id) for r in out.collect()} == want
    assert topk_inner_product(qdf, idf, 500).groupBy("qid").count().where("count != 101").count() == 0


def test_pair_dot_unknown_is_zero(spark):
    f = spark.createDataFrame([(1, [1.0, 2.0]), (10, [3.0, 4.0]), (20, [-1.0, 0.0])], "id long, features array<float>")
    pairs = spark.createDataFrame([(1, 10), (1, 20), (1, 30), (2, 10)], "uid long, item_id long")
    out = pair_dot(pairs, f.where("id < 5"), f.where("id >= 10"))
    assert rows(out, "uid", "item_id", "als_dot", "als_rank") == [(1, 10, 11.0, 1), (1, 20, -1.0, 3),
                                                                  (1, 30, 0.0, 2), (2, 10, 0.0, 1)]


@pytest.mark.slow
def test_ials_properties(spark):
    from tandem.plans.retrieval import IALS, IALSItemToItem, GlobalPopularity
    from tandem.plans.evaluation import recall_at_k
    df, data = _planted(spark, n_users=150, n_items=60)
    train = df.where("timestamp < 800")
    test = df.where("timestamp >= 800")
    users = df.select("uid").distinct()
    g = IALS(factors=8, iterations=8).fit(train)
    assert g.item_factors.count() == train.select("item_id").distinct().count()
    assert len(g.user_factors.first().features) == 8
    recs = g.generate(users, train, 10)
    assert recs.groupBy("uid").count().where("count != 10").count() == 0
    pop = GlobalPopularity(10).fit(train).generate(users, train, 10)
    r_als = recall_at_k(test, recs, 10).first().recall
    r_pop = recall_at_k(test, pop, 10).first().recall
    assert r_als > r_pop
    i2i = IALSItemToItem(g, n_last_items=3, n_similar_per_item=5).generate(users, train, 10)
    assert i2i.count() > 0 and i2i.select("uid", "item_id").distinct().count() == i2i.count()


@pytest.mark.slow
def test_ranker_auc_separable(spark):
    from tandem.plans.ranking import fit_ranker, prepare
    rng = np.random.default_rng(2)
    a = rng.normal(size=4000)
    y = ((a + 0.3 * rng.normal(size=4000)) > 1.6).astype(int)
    df = spark.createDataFrame([(i, i, float(a[i]), float(rng.normal()), int(y[i])) for i in range(4000)],
                               "uid long, item_id long, fa double, fb double, target int")
    tr, feats = prepare(df, True, 0.5)
    assert feats == ["fa", "fb"]
    ranker = fit_ranker(tr, feats, iterations=10, depth=3)
    assert ranker.auc(df) > 0.9
    scored = ranker.predict(df)
    assert scored.count() == 4000 and scored.where("score < 0 or score > 1").count() == 0
    with pytest.raises(ValueError):
        ranker.predict(df.drop("fb"))


def test_fitted_store_reuse(spark, likes, tmp_path):
    from tandem.plans.retrieval import GlobalPopularity
    from tandem.sources.io import FittedStore
    store = FittedStore(spark, str(tmp_path), prefix="quick")
    g = GlobalPopularity(2, store=store).fit(likes)
    assert store.exists("global_pop", "top_items")
    assert rows(g.top_items, "item_id") == [(10,), (20,)]
    g2 = GlobalPopularity(3, store=store).fit(likes)          # reused, not refitted
    assert g2.top_items.count() == 2
    g3 = GlobalPopularity(3, store=store).fit(likes, force=True)
    assert g3.top_items.count() == 3


def test_submission_csv_roundtrip(spark, tmp_path):
    from tandem.sources.io import read_target_users, write_submission
    sub = spark.createDataFrame([(1, "10 20"), (2, "")], "uid long, item_ids string")
    write_submission(sub, str(tmp_path / "sub"))
    back = spark.read.option("header", True).csv(str(tmp_path / "sub"))
    assert sorted((int(r.uid), r.item_ids or "") for r in back.collect()) == [(1, "10 20"), (2, "")]
    (tmp_path / "users.csv").write_text("uid\n5\n7\n")
    assert rows(read_target_users(spark, str(tmp_path / "users.csv"))) == [(5,), (7,)]


def test_ease_store_reuse(spark, likes, tmp_path):
    from tandem.plans.retrieval import Ease
    from tandem.sources.io import FittedStore
    store = FittedStore(spark, str(tmp_path))
    g = Ease(top_k_items=2, l2_reg=1.0, store=store).fit(likes)
    assert store.exists("ease", "model/weights")
    g2 = Ease(top_k_items=2, l2_reg=1.0, store=store).fit(likes)
    assert g2.model.n_items == 2
    users = spark.createDataFrame([(1,), (2,)], "uid long")
    assert rows(g.generate(users, likes, 5), "uid", "item_id") == rows(g2.generate(users, likes, 5), "uid", "item_id")


@pytest.mark.slow
def test_ials_large_ids_are_encoded(spark):
    from tandem.plans.retrieval import IALS
    big = 3_000_000_000
    data = [(big + u, big + (u * 7 + k) % 40, k, 1) for u in range(30) for k in range(6)]
    df = spark.createDataFrame(data, "uid long, item_id long, timestamp long, is_organic int")
    g = IALS(factors=4, iterations=3).fit(df)
    assert g.encoded
    assert g.user_factors.agg(F.min("id")).first()[0] >= big
    users = spark.createDataFrame([(big + 1,), (big + 2,), (5,)], "uid long")
    out = g.generate(users, df, 5)
    assert sorted({r.uid for r in out.collect()}) == [big + 1, big + 2]
    assert out.agg(F.min("item_id")).first()[0] >= big and out.count() == 10


@pytest.mark.slow
def test_submitter_and_validate(spark, likes, users, tmp_path):
    from tandem.plans.dataset import RecPipeline
    from tandem.plans.features import CandidateSourceCount, FeatureManager, UserStatic
    from tandem.plans.ranking import fit_ranker, prepare, validate
    from tandem.plans.retrieval import CoVisitation, GlobalPopularity, RetrievalStage
    from tandem.plans.submission import Submitter
    pipe = RecPipeline(RetrievalStage([GlobalPopularity(3), CoVisitation(10, 5)]),
                       FeatureManager([UserStatic(), CandidateSourceCount()])).fit_all(likes)
    truth = spark.createDataFrame([(2, 30), (3, 10), (5, 20)], "uid long, item_id long")
    ds = pipe.create_dataset(users, likes, truth, 10)
    train, feats = prepare(ds, True, 1.0)
    ranker = fit_ranker(train, feats, iterations=3, depth=2)
    r = validate(ranker, ds, truth, 10).first()
    assert r.truth_rows == 3 and 0 <= r.recall <= 1
    sub = Submitter(ranker, pipe).create_submission(users, likes, str(tmp_path / "sub"), 10, k=2)
    got = dict(sub.collect())
    assert set(got) == {1, 2, 3, 5} and got[1] == "40" and len(got[5].split()) == 2
    with pytest.raises(ValueError):
        Submitter(ranker, None).create_submission(users, likes)


@pytest.mark.parametrize("tile", [1024, 8, 41])
def test_ease_with_an_isolated_item(spark, tile):
    """An item that co-occurs with nothing leaves the rest of its block intact."""
    rng = np.random.default_rng(5)
    data = [(u, int(i)) for u in range(60) for i in rng.choice(40, 6, replace=False)] + [(1000, 40), (1001, 40)]
    likes = spark.createDataFrame([(u, i, 1, 1) for u, i in data], "uid long, item_id long, timestamp long, is_organic int")
    model = ease.fit(likes, top_k_items=100, l2_reg=3.0, tile=tile)
    x = np.zeros((62, 41))
    users = sorted({u for u, _ in data})
    for u, i in data:
        x[users.index(u), i] += 1
    p = np.linalg.inv(x.T @ x + 3.0 * np.eye(41))
    b = p / -np.diag(p)
    np.fill_diagonal(b, 0.0)
    got = np.zeros_like(b)
    for r in model.weights_long(spark).collect():
        got[r.item_i, r.item_j] = r.w
    assert np.abs(got - b).max() < 1e-10
    assert all(r.ok for r in ease.residual_check(model).collect()) and ease.residual_check(model).count() == 41
    top = {(r.uid, r.item_id): r.score for r in ease.score(model, likes, None, 41, user_block_rows=13).collect()}
    want = x @ b
    assert len(top) == 62 * 41 and max(abs(top[u, i] - want[k, i]) for k, u in enumerate(users) for i in range(41)) < 1e-9


def test_global_index_with_payload(spark):
    from pyspark.sql import functions as F
    from tandem.operators.topk import global_index
    df = (spark.range(50_000).select((F.xxhash64("id") % 100_000).alias("k"), "id",
                                     F.repeat(F.lit("x"), 30).alias("payload")).repartition(7))
    rows = global_index(df, ["k", "id"], "idx", num_partitions=9).orderBy("idx").select("idx", "k", "id").collect()
    assert [r.idx for r in rows] == list(range(50_000))
    keys = [(r.k, r.id) for r in rows]
    assert keys == sorted(keys)


def test_ials_rejects_alpha_one_and_serves_cold_big_ids(spark, likes):
    from tandem.plans.retrieval import IALS
    with pytest.raises(ValueError):
        IALS(alpha=1.0)
    g = IALS(factors=4, iterations=2).fit(likes)
    users = spark.createDataFrame([(1,), (3_000_000_000,)], "uid long")
    assert {r.uid for r in g.generate(users, likes, 3).collect()} == {1}


def test_user_static_is_the_same_on_both_branches(spark, likes):
    from tandem.plans.features import UserStatic
    users = spark.createDataFrame([(1,), (2,)], "uid long")
    cands = spark.createDataFrame([(1, 10, 1.0), (3, 10, 1.0)], "uid long, item_id long, score double")
    got = [sorted(tuple(r) for r in UserStatic(broadcast_rows=n).fit(likes).transform(cands, users, likes)
                  .select("uid", "user_total_likes", "user_unique_items").collect()) for n in (0, 1000)]
    assert got[0] == got[1] == [(1, 4, 3), (3, 0, 0)]


def test_ranker_keeps_its_features(spark, tmp_path):
    from tandem.plans.ranking import Ranker, fit_ranker
    rng = np.random.default_rng(3)
    rows = [(k, k, float(a), float(b), int(a > 0)) for k, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "uid long, item_id long, fa double, fb double, target int")
    ranker = fit_ranker(df, iterations=3, depth=2)
    ranker.save(str(tmp_path / "r"))
    again = Ranker.load(str(tmp_path / "r"))
    assert again.features == ["fa", "fb"]
    a, b = (sorted(tuple(r) for r in x.predict(df).collect()) for x in (ranker, again))
    assert a == b and again.auc(df) > 0.95


def test_coverage_without_truth(spark):
    from tandem.plans.evaluation import coverage_by_flags
    ds = spark.createDataFrame([(1, 2, 1.0, 0)], "uid long, item_id long, is_a double, target int")
    raw = spark.createDataFrame([], "uid long, item_id long")
    assert coverage_by_flags(ds, raw).first()["contribution_pct"] is None


def test_vector_topk_skips_blocks_by_norm(spark):
    """Norms fall off, so most blocks cannot reach a query's K-th score and are not asked for; the rows stay exact."""
    from pyspark.sql import functions as F
    from tandem.operators import vectors
    rng = np.random.default_rng(8)
    it = rng.normal(size=(2000, 8)) * (0.995 ** np.arange(2000))[:, None]
    it[1500:1600] = it[3]        # equal norms share a class and are cut by hash
    q = np.vstack([rng.normal(size=(60, 8)), np.zeros((1, 8))])
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, features array<double>")
    idf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(it)], "id long, features array<double>")
    S = np.zeros((61, 2000))
    for j in range(8):
        S += q[:, j:j + 1] * it[:, j]
    got = {}
    for r in topk_inner_product(qdf, idf, 5, item_block_rows=50, query_block_rows=16).collect():
        got.setdefault(r.qid, []).append((-r.score, r.item_id))
    for a in range(61):
        assert [s for s, _ in sorted(got[a])] == pytest.approx(sorted(-S[a])[:5], abs=1e-9)
        if a == 60:
            assert [i for _, i in sorted(got[a])] == [0, 1, 2, 3, 4]
    blocks = vectors.NormBlocks(idf, 40, 50)
    n_blocks = sum(n for _, _, n in blocks.classes)
    tops = [top for _, top, _ in blocks.classes]
    assert tops == sorted(tops, reverse=True) and blocks.items.groupBy("_cls", "_sub").count().agg(F.max("count")).first()[0] < 150
    bars = spark.createDataFrame([(a, float(np.sort(S[a])[-5])) for a in range(61)], "qid long, bar double")
    asked = blocks.others(qdf.select(F.col("id").alias("qid"), vectors._norm("features").alias("_qnorm")).where("id < 60").join(bars, "qid"))
    assert asked.count() < 0.5 * 60 * (n_blocks - 1)


def test_ease_rounds_leave_no_tables_behind(spark, tmp_path):
    """Whatever the number of rounds: items, Gram tiles, weights and the size note are what is left."""
    import os
    df, _ = _planted(spark, n_users=40, n_items=30)
    model = ease.fit(df, top_k_items=100, l2_reg=2.0, tile=8, path=str(tmp_path / "m"), width=4)
    assert sorted(os.listdir(tmp_path / "m")) == ["gram", "items", "meta", "weights"]
    assert all(r.ok for r in ease.residual_check(model).collect())
    again = ease.load(spark, model.path)
    users = df.select("uid").distinct()
    a, b = (sorted(tuple(r) for r in ease.score(m, df, users, 7, stripes=s).collect()) for m, s in ((model, 1), (again, 3)))
    assert a == b and len(a) == 40 * 7


def test_ease_tiles_lie_in_files_of_their_own(spark, tmp_path):
    """A file's writer and reader hold all its tiles at once: one a file, however many tiles a task has."""
    df = spark.createDataFrame([(u, (u * 7 + k * k) % 23) for u in range(30) for k in range(4)], "uid long, item_id long")
    model = ease.fit(df, top_k_items=100, l2_reg=2.0, tile=8, path=str(tmp_path / "m"), width=4)
    for name, rows in (("gram", 6), ("weights", 18)):
        tiles = spark.read.parquet(f"{model.path}/{name}")
        files = [len(part) for part in tiles.select("bi", F.input_file_name().alias("f")).toPandas().groupby("f")["bi"].apply(list)]
        assert files == [1] * rows
    assert all(r.ok for r in ease.residual_check(model).collect())


def test_ease_column_width():
    assert ease.column_width(2000, 2048) == 2048 and ease.column_width(60_000, 2048) == 512
    assert ease.column_width(10**7, 2048) == 64 and ease.column_width(10, 16) == 16
