import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators.similarity import cooccurrence
from tandem.plans.dataset import RecPipeline
from tandem.plans.evaluation import recall_at_k
from tandem.plans.features import (ArtistStatic, CandidateSourceCount, FeatureManager, ItemStatic, ItemTrend,
                                   UserArtistAffinity, UserStatic)
from tandem.plans.retrieval import ArtistPopularity, CoVisitation, GlobalPopularity, RetrievalStage
from tandem.plans.submission import format_top_k
from tests.conftest import DAY, rows


def test_cooccurrence_micro(likes):
    got = {(r.item_i, r.item_j): r.w for r in cooccurrence(likes).collect()}
    want = {(10, 20): 3, (10, 30): 2, (20, 30): 1, (30, 40): 1}
    want.update({(j, i): w for (i, j), w in list(want.items())})
    assert got == want


def test_cooccurrence_heavy_user_matches_numpy(spark):
    rng = np.random.default_rng(0)
    data = [(0, int(i)) for i in range(400)] + [(int(u), int(i)) for u in range(1, 200)
                                                for i in rng.choice(400, 5, replace=False)]
    df = spark.createDataFrame(data, "uid long, item_id long")
    X = np.zeros((200, 400))
    for u, i in data:
        X[u, i] += 1
    G = X.T @ X
    np.fill_diagonal(G, 0)
    got = np.zeros_like(G)
    for r in cooccurrence(df).collect():
        got[r.item_i, r.item_j] = r.w
    assert np.array_equal(got, G)


def test_global_popularity_minus_history(likes, users):
    stage = RetrievalStage([GlobalPopularity(top_n=3)]).fit_all(likes)
    out = stage.fetch_all(users, likes, 200)
    assert rows(out, "uid", "item_id", "score") == [(2, 30, 2.0), (3, 10, 3.0), (3, 20, 2.0),
                                                    (5, 10, 3.0), (5, 20, 2.0), (5, 30, 2.0)]


def test_covisitation_depth2_user2(spark, likes):
    u2 = spark.createDataFrame([(2,)], "uid long")
    gen = CoVisitation(top_k_similar=100, history_depth=2).fit(likes)
    before = gen.generate(u2, likes, 200)
    assert rows(before, "item_id", "score") == [(10, 3.0), (20, 3.0), (30, 3.0)]
    after = RetrievalStage([gen]).fetch_all(u2, likes, 200)
    assert rows(after, "item_id", "score") == [(30, 3.0)]


def test_merge_flags_and_source_count(spark, likes):
    u2 = spark.createDataFrame([(2,)], "uid long")
    stage = RetrievalStage([GlobalPopularity(3), CoVisitation(100, 2)]).fit_all(likes)
    merged = CandidateSourceCount().transform(stage.fetch_all(u2, likes, 200), u2, likes)
    r = merged.where("item_id = 30").first()
    assert (r.score, r.is_global_pop, r.is_covisitation, r.source_count) == (3.0, 1.0, 1.0, 2.0)


def test_artist_popularity(likes, mapping, users):
    gen = ArtistPopularity(mapping, top_n_artists=1, tracks_per_artist=1).fit(likes)
    assert rows(gen.top_tracks, "artist_id", "item_id", "artist_score") == [(1, 10, 3.0), (2, 30, 2.0), (3, 40, 1.0)]
    out = gen.generate(users, likes, 200)
    # user 1: artist 1 (3 likes) -> track 10; user 2: artist 1 -> 10;
    # user 3: items 30 and 40 both map to artist 2 (2 likes) -> track 30
    assert rows(out, "uid", "item_id") == [(1, 10), (2, 10), (3, 30)]


def test_feature_sources_micro(spark, likes, mapping):
    users = spark.createDataFrame([(u,) for u in (1, 2, 3, 4, 5)], "uid long")
    cands = spark.createDataFrame([(1, 40), (5, 10), (3, 99), (2, 30)], "uid long, item_id long")
    fm = FeatureManager([ItemStatic(mapping), UserStatic(), ItemTrend(days_trend=100),
                         UserArtistAffinity(mapping), ArtistStatic(mapping)]).fit_all(likes)
    out = {(r.uid, r.item_id): r for r in fm.extract(cands, users, likes).collect()}
    r = out[(1, 40)]
    assert (r.item_cnt_likes, r.item_organic_ratio, r.artist_id) == (1, 0.0, 2)
    assert (r.user_total_likes, r.user_unique_items) == (4, 3)
    assert (r.item_likes_last_100d, r.item_trend_ratio) == (1, 1.0)
    assert r.user_artist_likes_cnt == 1            # user 1 liked item 30 of artist 2
    assert (r.artist_total_likes, r.artist_unique_liked_tracks) == (3, 2)
    r = out[(5, 10)]
    assert (r.user_total_likes, r.user_unique_items, r.user_artist_likes_cnt) == (0, 0, 0)
    assert (r.item_organic_ratio, r.artist_total_likes) == (pytest.approx(2 / 3), 5)
    r = out[(3, 99)]
    assert (r.artist_id, r.item_likes_last_100d, r.item_trend_ratio) == (0, 0, 0.0)
    assert out[(2, 30)].item_trend_ratio == 0.5


def test_submission_and_recall(spark, likes, users):
    cands = RetrievalStage([GlobalPopularity(3)]).fit_all(likes).fetch_all(users, likes, 200)
    sub = dict(format_top_k(cands, users, 2).collect())
    assert sub == {1: "", 2: "30", 3: "10 20", 5: "10 20"}
    truth = spark.createDataFrame([(1, 40), (2, 30), (3, 10), (3, 10), (5, 77)], "uid long, item_id long")
    r = recall_at_k(truth, cands, 1).first()
    assert (r.hits, r.truth_rows, r.recall) == (3, 5, 0.6)


def test_dataset_invariants(spark, likes, mapping, users):
    hist = likes.where(F.col("timestamp") < 300 * DAY)
    labels = likes.where(F.col("timestamp") >= 300 * DAY)
    pipe = RecPipeline(RetrievalStage([GlobalPopularity(3), CoVisitation(100, 30), ArtistPopularity(mapping)]),
                       FeatureManager([ItemStatic(mapping), UserStatic(), CandidateSourceCount()])).fit_all(hist)
    ds = pipe.create_dataset(users, hist, labels, 200)
    assert ds.count() == ds.select("uid", "item_id").distinct().count()
    assert ds.join(hist, ["uid", "item_id"], "left_semi").count() == 0
    assert ds.where("source_count < 1").count() == 0
    assert {r.target for r in ds.select("target").distinct().collect()} <= {0, 1}


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "uid long, item_id long, timestamp long, is_organic int")
    users = spark.createDataFrame([], "uid long")
    stage = RetrievalStage([GlobalPopularity(3), CoVisitation(10, 5)]).fit_all(empty)
    out = stage.fetch_all(users, empty, 10)
    assert out.count() == 0 and "is_covisitation" in out.columns


def test_salted_pairs_equal_plain(spark):
    from tandem.operators.interactions import pair_counts
    from tandem.operators.similarity import upper_pairs
    rng = np.random.default_rng(3)
    data = [(0, int(i)) for i in range(300)] + [(1, int(i)) for i in range(0, 300, 3)] + \
           [(int(u), int(i)) for u in range(2, 100) for i in rng.choice(300, 4, replace=False)]
    counts = pair_counts(spark.createDataFrame(data, "uid long, item_id long"))
    salted = upper_pairs(counts, heavy_items=50, max_salt=8)
    plain = upper_pairs(counts, max_salt=1)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    assert salted.count() == plain.count() > 0


def test_empty_inputs_keep_schema(spark, mapping):
    from tandem.operators.vectors import topk_inner_product
    from tandem.operators import ease
    empty = spark.createDataFrame([], "uid long, item_id long, timestamp long, is_organic int")
    users = spark.createDataFrame([(1,), (2,)], "uid long")
    cands = spark.createDataFrame([], "uid long, item_id long, score double")
    fm = FeatureManager([ItemStatic(mapping), UserStatic(), ItemTrend(), UserArtistAffinity(mapping),
                         ArtistStatic(mapping), CandidateSourceCount()]).fit_all(empty)
    out = fm.extract(cands, users, empty)
    assert out.count() == 0
    assert {"item_cnt_likes", "user_total_likes", "item_trend_ratio", "user_artist_likes_cnt",
            "artist_total_likes"} <= set(out.columns)
    sub = dict(format_top_k(cands, users, 5).collect())
    assert sub == {1: "", 2: ""}
    vecs = spark.createDataFrame([], "id long, features array<float>")
    assert topk_inner_product(vecs, vecs, 3).count() == 0
    model = ease.fit(empty, top_k_items=10)
    assert model.n_items == 0 and ease.score(model, empty, users, 5).count() == 0
    assert ease.residual_check(model).count() == 0


def test_dataset_independent_of_shuffle_partitions(spark, likes, mapping, users):
    def build():
        hist = likes.where(F.col("timestamp") < 300 * DAY)
        labels = likes.where(F.col("timestamp") >= 300 * DAY)
        pipe = RecPipeline(RetrievalStage([GlobalPopularity(3), CoVisitation(100, 30), ArtistPopularity(mapping)]),
                           FeatureManager([ItemStatic(mapping), UserStatic(), UserArtistAffinity(mapping),
                                           ArtistStatic(mapping), CandidateSourceCount()])).fit_all(hist)
        return rows(pipe.create_dataset(users, hist, labels, 200))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = build()
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = build()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many and len(one) > 0


def test_users_in_shares_give_the_same_rows(spark, monkeypatch):
    """Merging and co-visitation scoring, share by share of the users, each written before the next is begun."""
    from tandem.operators import similarity

    rng = np.random.default_rng(11)
    rows = [(u, int(i), t, 1) for u in range(40) for t, i in enumerate(rng.choice(60, 8, replace=False))]
    likes = spark.createDataFrame([*rows, (None, 3, 1, 1)], "uid long, item_id long, timestamp long, is_organic int")
    users = spark.createDataFrame([(u,) for u in [*range(45), 7, None]], "uid long")
    written = []
    real = similarity.materialise
    monkeypatch.setattr(similarity, "materialise", lambda df: written.append(df.columns) or real(df))

    def merged(pass_rows):
        stage = RetrievalStage([GlobalPopularity(5), CoVisitation(10, 5)], pass_rows).fit_all(likes)
        return sorted(map(str, stage.fetch_all(users, likes, 20).collect()))

    want = merged(10**9)
    assert sum("is_covisitation" in c for c in written) == 0
    assert merged(500) == want and sum("is_covisitation" in c for c in written) == 4
    table = CoVisitation(10, 5).fit(likes).similarity
    del written[:]
    one = sorted(similarity.covisitation_scores(likes, table, users, 5, 20).collect())
    assert sorted(similarity.covisitation_scores(likes, table, users, 5, 20, pass_pairs=600).collect()) == one
    assert sum(c == ["uid", "item_id", "score"] for c in written) == 4
