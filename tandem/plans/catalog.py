"""Registered queries: one Spark builder per operator of the inventory, and
its DuckDB twin where SQL can express it.

Every query reads the driver tables through ``tandem.sources.testdata`` and
runs over whole tables. Parameters are the reference defaults. The training
setting is the "quick" temporal split: fit on ``timestamp < t1``, label window
``[t1, t2)``, target users = users of the label window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators import ease as ease_ops
from tandem.operators.interactions import item_counts
from tandem.operators.joins import bounded_broadcast
from tandem.operators.sampling import (cap_history, downsample_negatives, positional_split, sample_users_to_rows,
                                       temporal_split)
from tandem.operators.similarity import cooccurrence, sparsify
from tandem.operators.topk import global_top_n, latest_events
from tandem.operators.vectors import pair_dot, topk_inner_product
from tandem.plans import checks
from tandem.plans.chain import Chain, full_pipeline
from tandem.plans.dataset import RecPipeline, attach_target
from tandem.plans.evaluation import auc, coverage_by_flags, coverage_by_generator, recall_at_k, target_counts
from tandem.plans.features import (ArtistStatic, CandidateSourceCount, FeatureManager, IALSDot, ItemStatic,
                                   ItemTrend, UserArtistAffinity, UserStatic)
from tandem.plans.retrieval import (IALS, ArtistPopularity, CoVisitation, Ease, GlobalPopularity,
                                    IALSItemToItem, RetrievalStage)
from tandem.plans.submission import format_top_k
from tandem.sources import testdata as td
from tandem.sources.io import materialise

# Fixed values (reference defaults)
TOP_N_POPULAR = 100
TOP_N_ARTISTS = 10
TRACKS_PER_ARTIST = 10
TOP_K_SIMILAR = 100
HISTORY_DEPTH = 30
NUM_CANDIDATES = 200
DAYS_TREND = 14
HISTORY_CAP = 5
LATEST_N = 5000
SUBMISSION_K = 100
RECALL_K = 100
NEG_FRACTION = 0.05
SEED = 42
EASE_TOP_K_ITEMS = 60000
EASE_L2 = 500.0
VECTOR_K = 10
RANKER_TREES = 700
HELD_OUT = 0.2  # share of users whose rows the ranker never sees


# ----------------------------------------------------------------- Spark side
def _likes(spark, sf):
    return td.likes(spark, sf)


def _train(spark, sf):
    likes = materialise(_likes(spark, sf))  # every generator and feature source reads them: joined once
    hist, train, _, _ = temporal_split(likes, 1)
    return likes, hist, train, train.select("uid").distinct()


def _generators(spark, sf):
    mapping = td.artist_mapping(spark, sf)
    return [GlobalPopularity(TOP_N_POPULAR), ArtistPopularity(mapping, TOP_N_ARTISTS, TRACKS_PER_ARTIST),
            CoVisitation(TOP_K_SIMILAR, HISTORY_DEPTH)]


def _merged(spark, sf):
    likes, hist, train, users = _train(spark, sf)
    stage = RetrievalStage(_generators(spark, sf)).fit_all(hist)
    return stage.fetch_all(users, hist, NUM_CANDIDATES), hist, train, users


def _feature(source_factory):
    def run(spark, sf):
        cands, hist, train, users = _merged(spark, sf)
        src = source_factory(spark, sf).fit(hist)
        return src.transform(cands, users, hist)
    return run


def _sql_sources(spark, sf):
    mapping = td.artist_mapping(spark, sf)
    return [ItemStatic(mapping), UserStatic(), ItemTrend(DAYS_TREND), UserArtistAffinity(mapping),
            ArtistStatic(mapping), CandidateSourceCount()]


def _dataset(spark, sf):
    likes, hist, train, users = _train(spark, sf)
    pipe = RecPipeline(RetrievalStage(_generators(spark, sf)), FeatureManager(_sql_sources(spark, sf)))
    return pipe.fit_all(hist).create_dataset(users, hist, train, NUM_CANDIDATES), train


def _popular_unseen(spark, sf):
    likes = materialise(_likes(spark, sf))
    # dealt by user before the top items multiply the rows: what follows ranks within users and needs no other exchange
    users = td.target_users(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "uid")
    gp = GlobalPopularity(TOP_N_POPULAR).fit(likes)
    # only likes of the top items can meet a candidate
    seen = materialise(likes.select("uid", "item_id").join(F.broadcast(gp.top_items.select("item_id")), "item_id", "left_semi"))
    return gp.generate(users, likes, NUM_CANDIDATES).join(bounded_broadcast(seen.select("uid", "item_id")),
                                                         ["uid", "item_id"], "left_anti"), users, likes


def q_item_popularity_top(spark, sf):
    return global_top_n(item_counts(_likes(spark, sf)), [F.desc("n"), F.asc("item_id")], TOP_N_POPULAR)


def q_popular_unseen_top100(spark, sf):
    cands, users, _ = _popular_unseen(spark, sf)
    return format_top_k(cands, users, SUBMISSION_K)


def q_latest_events(spark, sf):
    return latest_events(_likes(spark, sf), LATEST_N)


def q_user_history_cap(spark, sf):
    return cap_history(_likes(spark, sf), HISTORY_CAP)


def q_user_sample_to_target(spark, sf):
    capped = materialise(cap_history(_likes(spark, sf), HISTORY_CAP))  # counted, listed and filtered: read from files
    return sample_users_to_rows(capped, capped.count() // 2, SEED)


def _parts(split):
    """The four frames of a temporal split as one, with a ``part`` column."""
    names = ["hist_train", "train", "val_hist", "val"]
    out = split[0].withColumn("part", F.lit(names[0]))
    for p, name in zip(split[1:], names[1:]):
        out = out.unionByName(p.withColumn("part", F.lit(name)))
    return out


def q_split_temporal(spark, sf):
    return _parts(temporal_split(_likes(spark, sf), 1))


def q_split_positional(spark, sf):
    return positional_split(_likes(spark, sf))


def q_negative_downsample(spark, sf):
    likes, hist, train, users = _train(spark, sf)
    gp = GlobalPopularity(TOP_N_POPULAR).fit(hist)
    cands = gp.generate(users, hist, NUM_CANDIDATES).join(hist.select("uid", "item_id"),
                                                         ["uid", "item_id"], "left_anti")
    ds = attach_target(cands.select("uid", "item_id"), train)
    return downsample_negatives(ds, NEG_FRACTION, SEED)


def q_artist_top_tracks(spark, sf):
    return ArtistPopularity(td.artist_mapping(spark, sf), TOP_N_ARTISTS, TRACKS_PER_ARTIST).fit(
        _likes(spark, sf)).top_tracks


def q_artist_pop_candidates(spark, sf):
    likes = _likes(spark, sf)
    g = ArtistPopularity(td.artist_mapping(spark, sf), TOP_N_ARTISTS, TRACKS_PER_ARTIST).fit(likes)
    return g.generate(td.target_users(spark, sf), likes, NUM_CANDIDATES)


def q_global_pop_candidates(spark, sf):
    likes = _likes(spark, sf)
    return GlobalPopularity(TOP_N_POPULAR).fit(likes).generate(td.target_users(spark, sf), likes, NUM_CANDIDATES)


def q_cooccurrence_pairs(spark, sf):
    return cooccurrence(_likes(spark, sf))


def q_covisitation_topk(spark, sf):
    return sparsify(cooccurrence(_likes(spark, sf), most=TOP_K_SIMILAR), TOP_K_SIMILAR)


def q_covisitation_candidates(spark, sf):
    likes = _likes(spark, sf)
    g = CoVisitation(TOP_K_SIMILAR, HISTORY_DEPTH).fit(likes)
    return g.generate(td.target_users(spark, sf), likes, NUM_CANDIDATES)


def q_retrieval_merge(spark, sf):
    return _merged(spark, sf)[0]


def q_dataset_with_target(spark, sf):
    return _dataset(spark, sf)[0]


def q_coverage_by_generator(spark, sf):
    # the dataset is read twice (numerator and the user set of the
    # denominator): materialise it once, as the reference saves it first
    ds, train = _dataset(spark, sf)
    return coverage_by_generator(materialise(ds), train)


def q_coverage_by_flags(spark, sf):
    ds, train = _dataset(spark, sf)
    return coverage_by_flags(materialise(ds), train)


def q_target_counts(spark, sf):
    return target_counts(_dataset(spark, sf)[0])


def q_recall_at_k(spark, sf):
    cands, hist, train, users = _merged(spark, sf)
    return recall_at_k(train, cands, RECALL_K)


def q_submission(spark, sf):
    cands, hist, train, users = _merged(spark, sf)
    return format_top_k(cands, users, SUBMISSION_K)


def q_vector_topk_join(spark, sf):
    v = td.vectors(spark, sf)
    return topk_inner_product(v, v, VECTOR_K).withColumn("score", F.round("score", 4))


def q_pair_dot_rank(spark, sf):
    cands, _, _ = _popular_unseen(spark, sf)
    v = td.vectors(spark, sf)
    out = pair_dot(cands.select("uid", "item_id"), v, v, "als_dot", "als_rank")
    return out.select("uid", "item_id", F.round("als_dot", 4).alias("als_dot"),
                      F.col("als_rank").cast("long").alias("als_rank"))


def q_ease_gram(spark, sf):
    return ease_ops.gram(_likes(spark, sf), EASE_TOP_K_ITEMS, EASE_L2)


def q_ease_weight_residual(spark, sf):
    return ease_ops.residual_check(ease_ops.fit(_likes(spark, sf), EASE_TOP_K_ITEMS, EASE_L2))


def q_ease_candidates(spark, sf):
    likes = _likes(spark, sf)
    g = Ease(EASE_TOP_K_ITEMS, EASE_L2).fit(likes)
    return g.generate(td.target_users(spark, sf), likes, NUM_CANDIDATES)


_IALS: dict = {}


def _ials(spark, sf):
    """Fit once per (session, data folder); the three ALS queries share it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _IALS:
        likes = _likes(spark, sf)
        _IALS.clear()
        _IALS[key] = (IALS().fit(likes), likes)
    return _IALS[key]


def q_ials_candidates(spark, sf):
    g, likes = _ials(spark, sf)
    return g.generate(td.target_users(spark, sf), likes, NUM_CANDIDATES)


def q_ials_i2i_candidates(spark, sf):
    g, likes = _ials(spark, sf)
    return IALSItemToItem(g).generate(td.target_users(spark, sf), likes, NUM_CANDIDATES)


def q_feat_ials_dot(spark, sf):
    g, likes = _ials(spark, sf)
    cands, _, _, users = _merged(spark, sf)
    return IALSDot(g).transform(cands.select("uid", "item_id", "score"), users, likes)


def q_ease_scores_check(spark, sf):
    likes, users = _likes(spark, sf), td.target_users(spark, sf)
    g = Ease(EASE_TOP_K_ITEMS, EASE_L2).fit(likes)
    return checks.ease_scores(g.model, likes, users, g.generate(users, likes, NUM_CANDIDATES), NUM_CANDIDATES)


def q_ials_normal_equations(spark, sf):
    g, likes = _ials(spark, sf)
    return checks.als_normal_equations(g, likes)


def q_ials_topk_check(spark, sf):
    g, likes = _ials(spark, sf)
    users = td.target_users(spark, sf)
    return checks.als_user_topk(g, users, g.generate(users, likes, NUM_CANDIDATES), NUM_CANDIDATES)


def q_ials_i2i_check(spark, sf):
    g, likes = _ials(spark, sf)
    users, i2i = td.target_users(spark, sf), IALSItemToItem(g)
    return checks.als_item_to_item(i2i, likes, users, i2i.generate(users, likes, NUM_CANDIDATES), NUM_CANDIDATES)


def q_feat_ials_dot_check(spark, sf):
    g, _ = _ials(spark, sf)
    return checks.pair_dots(g, q_feat_ials_dot(spark, sf))


def q_split_temporal_long(spark, sf):
    return _parts(temporal_split(_likes(spark, sf), 2))


def q_artist_top_tracks_multi(spark, sf):
    return ArtistPopularity(td.artist_mapping_multi(spark, sf), TOP_N_ARTISTS, TRACKS_PER_ARTIST).fit(
        _likes(spark, sf)).top_tracks


def q_artist_pop_candidates_multi(spark, sf):
    likes = _likes(spark, sf)
    g = ArtistPopularity(td.artist_mapping_multi(spark, sf), TOP_N_ARTISTS, TRACKS_PER_ARTIST).fit(likes)
    return g.generate(td.target_users(spark, sf), likes, NUM_CANDIDATES)


_CHAINS: dict = {}


def _chain(spark, sf):
    """All generators and sources, fitted and ranked once per (session, data folder); the queries below share it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CHAINS:
        likes = materialise(_likes(spark, sf))
        hist, train, val_hist, val = temporal_split(likes, 1)
        run = Chain(full_pipeline(td.artist_mapping(spark, sf)), NUM_CANDIDATES, NEG_FRACTION, SEED, HELD_OUT, SUBMISSION_K,
                    iterations=RANKER_TREES)
        _CHAINS.clear()
        _CHAINS[key] = (run.train(hist, train), hist, train, val_hist, val)
    return _CHAINS[key]


def q_full_dataset(spark, sf):
    return _chain(spark, sf)[0].dataset


def q_full_submission(spark, sf):
    return _chain(spark, sf)[0].submission()


def q_full_chain_check(spark, sf):
    run, hist, train, _, _ = _chain(spark, sf)
    return checks.chain(run, hist, train)


def q_ranker_scores(spark, sf):
    return _chain(spark, sf)[0].scores()


def q_ranker_scores_check(spark, sf):
    """Every candidate of the three generators that SQL can express has one score, a probability."""
    run = _chain(spark, sf)[0]
    known = run.dataset.where("is_global_pop + is_artist_pop + is_covisitation > 0").select("uid", "item_id")
    return known.join(run.scores(), ["uid", "item_id"]).select("uid", "item_id", F.col("score").between(0.0, 1.0).alias("ok"))


def q_ranker_auc(spark, sf):
    return _chain(spark, sf)[0].held_out_auc()


def q_ranker_auc_check(spark, sf):
    """The rank sum against Spark ML's exact curve."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = materialise(_chain(spark, sf)[0].held_out_scores().withColumn("target", F.col("target").cast("double")))
    curve = BinaryClassificationEvaluator(labelCol="target", rawPredictionCol="score", metricName="areaUnderROC",
                                          numBins=0).evaluate(rows)
    return auc(rows).select((F.abs(F.col("auc") - F.lit(curve)) < 1e-9).alias("ok"))


def q_ranker_validation(spark, sf):
    """The ranker of the training window on the last window, everything else fitted anew."""
    run, _, _, val_hist, val = _chain(spark, sf)
    again = Chain(full_pipeline(td.artist_mapping(spark, sf)), NUM_CANDIDATES, k=RECALL_K)
    again.ranker = run.ranker
    return again.validation(val_hist, val)


def q_auc_merge_scores(spark, sf):
    """M15 over every merged candidate: the area under ROC of the merge score."""
    cands, _, train, _ = _merged(spark, sf)
    return auc(attach_target(cands.select("uid", "item_id", "score"), train))


QUERIES = {
    "item_popularity_top": q_item_popularity_top,
    "popular_unseen_top100": q_popular_unseen_top100,
    "latest_events": q_latest_events,
    "user_history_cap": q_user_history_cap,
    "user_sample_to_target": q_user_sample_to_target,
    "split_temporal": q_split_temporal,
    "split_positional": q_split_positional,
    "negative_downsample": q_negative_downsample,
    "artist_top_tracks": q_artist_top_tracks,
    "artist_pop_candidates": q_artist_pop_candidates,
    "global_pop_candidates": q_global_pop_candidates,
    "cooccurrence_pairs": q_cooccurrence_pairs,
    "covisitation_topk": q_covisitation_topk,
    "covisitation_candidates": q_covisitation_candidates,
    "retrieval_merge": q_retrieval_merge,
    "feat_item_static": _feature(lambda s, sf: ItemStatic(td.artist_mapping(s, sf))),
    "feat_user_static": _feature(lambda s, sf: UserStatic()),
    "feat_item_trend": _feature(lambda s, sf: ItemTrend(DAYS_TREND)),
    "feat_user_artist": _feature(lambda s, sf: UserArtistAffinity(td.artist_mapping(s, sf))),
    "feat_artist_static": _feature(lambda s, sf: ArtistStatic(td.artist_mapping(s, sf))),
    "feat_source_count": _feature(lambda s, sf: CandidateSourceCount()),
    "dataset_with_target": q_dataset_with_target,
    "coverage_by_generator": q_coverage_by_generator,
    "coverage_by_flags": q_coverage_by_flags,
    "target_counts": q_target_counts,
    "recall_at_k": q_recall_at_k,
    "submission": q_submission,
    "vector_topk_join": q_vector_topk_join,
    "pair_dot_rank": q_pair_dot_rank,
    "ease_gram": q_ease_gram,
    "ease_weight_residual": q_ease_weight_residual,
    "ease_candidates": q_ease_candidates,
    "ials_candidates": q_ials_candidates,
    "ials_i2i_candidates": q_ials_i2i_candidates,
    "feat_ials_dot": q_feat_ials_dot,
    "ease_scores_check": q_ease_scores_check,
    "ials_normal_equations": q_ials_normal_equations,
    "ials_topk_check": q_ials_topk_check,
    "ials_i2i_check": q_ials_i2i_check,
    "feat_ials_dot_check": q_feat_ials_dot_check,
    "split_temporal_long": q_split_temporal_long,
    "artist_top_tracks_multi": q_artist_top_tracks_multi,
    "artist_pop_candidates_multi": q_artist_pop_candidates_multi,
    "full_dataset": q_full_dataset,
    "full_submission": q_full_submission,
    "full_chain_check": q_full_chain_check,
    "ranker_scores": q_ranker_scores,
    "ranker_scores_check": q_ranker_scores_check,
    "ranker_auc": q_ranker_auc,
    "ranker_auc_check": q_ranker_auc_check,
    "ranker_validation": q_ranker_validation,
    "auc_merge_scores": q_auc_merge_scores,
}


# ------------------------------------------------------------------ SQL side
def _d(x) -> str:
    """A double literal for DuckDB (plain decimals would be DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


BASE = """likes AS (
  SELECT o_custkey AS uid, l_partkey AS item_id, CAST(epoch(l_shipdate) AS BIGINT) AS timestamp,
         CAST(l_returnflag = 'N' AS INTEGER) AS is_organic
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
artist_mapping AS (SELECT p_partkey AS item_id, CAST(substr(p_brand, 7) AS BIGINT) AS artist_id FROM part),
target_users AS (SELECT c_custkey AS uid FROM customer)"""

SPLIT = f"""bounds AS (SELECT min(timestamp) AS mn, max(timestamp) AS mx FROM likes),
thr AS (SELECT mn + CAST(floor(CAST(mx - mn AS DOUBLE) * {_d(0.93)}) AS BIGINT) AS t1,
               mn + CAST(floor(CAST(mx - mn AS DOUBLE) * {_d(0.98)}) AS BIGINT) AS t2 FROM bounds),
hist AS (SELECT l.* FROM likes l, thr WHERE l.timestamp < thr.t1),
train AS (SELECT l.* FROM likes l, thr WHERE l.timestamp >= thr.t1 AND l.timestamp < thr.t2),
val_hist AS (SELECT l.* FROM likes l, thr WHERE l.timestamp < thr.t2),
val AS (SELECT l.* FROM likes l, thr WHERE l.timestamp >= thr.t2),
train_users AS (SELECT DISTINCT uid FROM train)"""


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _avg_rank_keep(src: str, group: str, k: int) -> str:
    return (f"SELECT * FROM (SELECT *, rank() OVER w AS _r1, count(*) OVER w AS _r2 FROM {src} "
            f"WINDOW w AS (PARTITION BY {group} ORDER BY n DESC)) WHERE (_r1 + _r2) / {_d(2.0)} <= {k}")


def gen_global_pop(h: str, u: str) -> str:
    return f"""gp_top AS (SELECT item_id, CAST(count(*) AS DOUBLE) AS score FROM {h}
  GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT {TOP_N_POPULAR}),
gp AS (SELECT u.uid, t.item_id, t.score FROM {u} u CROSS JOIN gp_top t)"""


def gen_artist_pop(h: str, u: str) -> str:
    return f"""ap_c AS (SELECT artist_id, item_id, count(*) AS n FROM {h} JOIN artist_mapping USING (item_id)
  GROUP BY artist_id, item_id),
ap_top AS (SELECT artist_id, item_id, CAST(n AS DOUBLE) AS artist_score FROM ({_avg_rank_keep('ap_c', 'artist_id', TRACKS_PER_ARTIST)})),
ap_u AS (SELECT uid, artist_id, count(*) AS n FROM {h} JOIN artist_mapping USING (item_id)
  WHERE uid IN (SELECT uid FROM {u}) GROUP BY uid, artist_id),
ap_fav AS (SELECT uid, artist_id FROM ({_avg_rank_keep('ap_u', 'uid', TOP_N_ARTISTS)})),
ap AS (SELECT f.uid, t.item_id, t.artist_score AS score FROM ap_fav f JOIN ap_top t USING (artist_id))"""


def _cooc(h: str, prefix: str) -> str:
    return f"""{prefix}_c AS (SELECT uid, item_id, count(*) AS n FROM {h} GROUP BY uid, item_id),
{prefix}_g AS (SELECT a.item_id AS item_i, b.item_id AS item_j, CAST(sum(a.n * b.n) AS BIGINT) AS w
  FROM {prefix}_c a JOIN {prefix}_c b ON a.uid = b.uid AND a.item_id <> b.item_id GROUP BY 1, 2)"""


def _sparse(prefix: str) -> str:
    return f"""{prefix}_s AS (SELECT item_i, item_j, w FROM (SELECT *, row_number() OVER
  (PARTITION BY item_i ORDER BY w DESC, item_j) AS rn FROM {prefix}_g) WHERE rn <= {TOP_K_SIMILAR})"""


def gen_covisitation(h: str, u: str) -> str:
    return _cooc(h, "cv") + ",\n" + _sparse("cv") + f""",
cv_h AS (SELECT uid, item_id FROM (SELECT *, row_number() OVER (PARTITION BY uid
  ORDER BY timestamp DESC, item_id, is_organic DESC) AS rn FROM {h} WHERE uid IN (SELECT uid FROM {u}))
  WHERE rn <= {HISTORY_DEPTH}),
cv_sc AS (SELECT h.uid, s.item_j AS item_id, CAST(sum(s.w) AS DOUBLE) AS score
  FROM cv_h h JOIN cv_s s ON h.item_id = s.item_i GROUP BY 1, 2),
cv AS (SELECT uid, item_id, score FROM (SELECT *, row_number() OVER (PARTITION BY uid
  ORDER BY score DESC, item_id) AS rn FROM cv_sc) WHERE rn <= {NUM_CANDIDATES})"""


def merged_ctes(h: str = "hist", u: str = "train_users") -> list[str]:
    one, none = _d(1.0), "CAST(NULL AS DOUBLE)"
    return [BASE, SPLIT, gen_global_pop(h, u), gen_artist_pop(h, u), gen_covisitation(h, u),
            f"""m_all AS (SELECT uid, item_id, score, {one} AS f1, {none} AS f2, {none} AS f3 FROM gp
  UNION ALL SELECT uid, item_id, score, {none}, {one}, {none} FROM ap
  UNION ALL SELECT uid, item_id, score, {none}, {none}, {one} FROM cv),
merged AS (SELECT uid, item_id, max(score) AS score, coalesce(max(f1), {_d(0.0)}) AS is_global_pop,
  coalesce(max(f2), {_d(0.0)}) AS is_artist_pop, coalesce(max(f3), {_d(0.0)}) AS is_covisitation
  FROM m_all GROUP BY uid, item_id),
cands AS (SELECT * FROM merged m WHERE NOT EXISTS
  (SELECT 1 FROM {h} l WHERE l.uid = m.uid AND l.item_id = m.item_id))"""]


FEATURE_CTES = f"""f_part AS (SELECT item_id, min(coalesce(artist_id, 0)) AS artist_id FROM artist_mapping GROUP BY item_id),
f_item AS (SELECT s.*, p.artist_id FROM (SELECT item_id, count(*) AS item_cnt_likes,
  avg(is_organic) AS item_organic_ratio FROM hist GROUP BY item_id) s LEFT JOIN f_part p USING (item_id)),
f_user AS (SELECT uid, count(*) AS user_total_likes, count(DISTINCT item_id) AS user_unique_items
  FROM hist WHERE uid IN (SELECT uid FROM train_users) GROUP BY uid),
f_trend AS (SELECT item_id, count(*) FILTER (WHERE timestamp > (SELECT max(timestamp) FROM hist) - {DAYS_TREND * 86400})
  AS item_likes_last_{DAYS_TREND}d, count(*) AS total FROM hist GROUP BY item_id),
f_ua AS (SELECT uid, coalesce(artist_id, 0) AS art, count(*) AS user_artist_likes_cnt FROM hist
  JOIN artist_mapping USING (item_id) WHERE uid IN (SELECT uid FROM train_users) GROUP BY 1, 2),
f_art AS (SELECT coalesce(artist_id, 0) AS art, count(*) AS artist_total_likes,
  count(DISTINCT item_id) AS artist_unique_liked_tracks FROM hist JOIN artist_mapping USING (item_id) GROUP BY 1)"""

F_ITEM = ("LEFT JOIN f_item fi ON fi.item_id = c.item_id",
          "coalesce(fi.item_cnt_likes, 0) AS item_cnt_likes, coalesce(fi.item_organic_ratio, 0.0) AS item_organic_ratio, "
          "coalesce(fi.artist_id, 0) AS artist_id")
F_USER = ("LEFT JOIN f_user fu ON fu.uid = c.uid",
          "coalesce(fu.user_total_likes, 0) AS user_total_likes, coalesce(fu.user_unique_items, 0) AS user_unique_items")
F_TREND = ("LEFT JOIN f_trend ft ON ft.item_id = c.item_id",
           f"coalesce(ft.item_likes_last_{DAYS_TREND}d, 0) AS item_likes_last_{DAYS_TREND}d, "
           f"coalesce(CAST(ft.item_likes_last_{DAYS_TREND}d AS DOUBLE) / ft.total, 0.0) AS item_trend_ratio")
F_UA = ("LEFT JOIN f_part pa ON pa.item_id = c.item_id "
        "LEFT JOIN f_ua fa ON fa.uid = c.uid AND fa.art = coalesce(pa.artist_id, 0)",
        "coalesce(fa.user_artist_likes_cnt, 0) AS user_artist_likes_cnt")
F_ART = ("LEFT JOIN f_part pb ON pb.item_id = c.item_id "
         "LEFT JOIN f_art fs ON fs.art = coalesce(pb.artist_id, 0)",
         "coalesce(fs.artist_total_likes, 0) AS artist_total_likes, "
         "coalesce(fs.artist_unique_liked_tracks, 0) AS artist_unique_liked_tracks")
F_COUNT = ("", "c.is_global_pop + c.is_artist_pop + c.is_covisitation AS source_count")
F_TARGET = ("LEFT JOIN (SELECT DISTINCT uid, item_id FROM train) tg ON tg.uid = c.uid AND tg.item_id = c.item_id",
            "CAST(CASE WHEN tg.uid IS NULL THEN 0 ELSE 1 END AS INTEGER) AS target")


def _feature_sql(*parts) -> str:
    joins = " ".join(p[0] for p in parts if p[0])
    cols = ", ".join(p[1] for p in parts)
    return _with(*merged_ctes(), FEATURE_CTES, body=f"SELECT c.*, {cols} FROM cands c {joins}")


def _dataset_cte() -> list[str]:
    parts = (F_ITEM, F_USER, F_TREND, F_UA, F_ART, F_COUNT, F_TARGET)
    joins = " ".join(p[0] for p in parts if p[0])
    cols = ", ".join(p[1] for p in parts)
    return merged_ctes() + [FEATURE_CTES, f"ds AS (SELECT c.*, {cols} FROM cands c {joins})"]


_TOP_CANDS = f"""top AS (SELECT uid, item_id, rn FROM (SELECT *, row_number() OVER (PARTITION BY uid
  ORDER BY score DESC, item_id) AS rn FROM cands) WHERE rn <= {SUBMISSION_K})"""

_POP_UNSEEN = gen_global_pop("likes", "target_users") + """,
cands AS (SELECT * FROM gp g WHERE NOT EXISTS
  (SELECT 1 FROM likes l WHERE l.uid = g.uid AND l.item_id = g.item_id))"""


def _submission_body(users: str) -> str:
    return f"""SELECT u.uid, coalesce(s.item_ids, '') AS item_ids FROM {users} u LEFT JOIN
  (SELECT uid, string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY rn) AS item_ids FROM top GROUP BY uid) s
  ON s.uid = u.uid"""


def _recent(src: str, n: int) -> str:
    return (f"SELECT uid, item_id, timestamp, is_organic FROM (SELECT *, row_number() OVER (PARTITION BY uid "
            f"ORDER BY timestamp DESC, item_id, is_organic DESC) AS rn FROM {src}) WHERE rn <= {n}")


def _vec_dot(a: str, b: str) -> str:
    return f"list_dot_product(CAST({a}.embedding AS DOUBLE[]), CAST({b}.embedding AS DOUBLE[]))"


SQL = {
    "item_popularity_top": _with(BASE, body=f"""SELECT item_id, count(*) AS n FROM likes GROUP BY item_id
  ORDER BY n DESC, item_id LIMIT {TOP_N_POPULAR}"""),
    "popular_unseen_top100": _with(BASE, _POP_UNSEEN, _TOP_CANDS, body=_submission_body("target_users")),
    "latest_events": _with(BASE, body=f"""SELECT * FROM likes
  ORDER BY timestamp DESC, uid DESC, item_id DESC, is_organic DESC LIMIT {LATEST_N}"""),
    "user_history_cap": _with(BASE, body=_recent("likes", HISTORY_CAP)),
    "user_sample_to_target": _with(BASE, f"capped AS ({_recent('likes', HISTORY_CAP)})", f"""k AS (SELECT
  CAST(floor(CAST(count(*) // 2 AS DOUBLE) / count(*) * count(DISTINCT uid)) AS BIGINT) AS k FROM capped),
chosen AS (SELECT uid FROM (SELECT uid, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(uid AS VARCHAR)), uid) AS rn
  FROM (SELECT DISTINCT uid FROM capped)) WHERE rn <= (SELECT k FROM k))""",
                                   body="SELECT * FROM capped WHERE uid IN (SELECT uid FROM chosen)"),
    "split_temporal": _with(BASE, SPLIT, body="""SELECT *, 'hist_train' AS part FROM hist
  UNION ALL SELECT *, 'train' FROM train UNION ALL SELECT *, 'val_hist' FROM val_hist
  UNION ALL SELECT *, 'val' FROM val"""),
    "split_positional": _with(BASE, f"""ix AS (SELECT *, row_number() OVER (ORDER BY timestamp, uid, item_id, is_organic) - 1 AS idx,
  count(*) OVER () AS n FROM likes)""", body=f"""SELECT uid, item_id, timestamp, is_organic,
  CASE WHEN idx < CAST(floor(n * {_d(0.6)}) AS BIGINT) THEN 'hist'
       WHEN idx < CAST(floor(n * {_d(0.8)}) AS BIGINT) THEN 'train' ELSE 'val' END AS part FROM ix"""),
    "negative_downsample": _with(BASE, SPLIT, gen_global_pop("hist", "train_users"), f"""cands AS (SELECT uid, item_id FROM gp g
  WHERE NOT EXISTS (SELECT 1 FROM hist l WHERE l.uid = g.uid AND l.item_id = g.item_id)),
ds AS (SELECT c.uid, c.item_id, CAST(CASE WHEN tg.uid IS NULL THEN 0 ELSE 1 END AS INTEGER) AS target FROM cands c
  LEFT JOIN (SELECT DISTINCT uid, item_id FROM train) tg ON tg.uid = c.uid AND tg.item_id = c.item_id)""",
                                 body=f"""SELECT * FROM ds WHERE target = 1 OR (target = 0 AND
  substr(md5('{SEED}:' || CAST(uid AS VARCHAR) || ':' || CAST(item_id AS VARCHAR)), 1, 8) < '{format(int(NEG_FRACTION * 4294967296.0), '08x')}')"""),
    "artist_top_tracks": _with(BASE, gen_artist_pop("likes", "target_users"),
                               body="SELECT artist_id, item_id, artist_score FROM ap_top"),
    "artist_pop_candidates": _with(BASE, gen_artist_pop("likes", "target_users"),
                                   body="SELECT uid, item_id, score, 'artist_pop' AS source FROM ap"),
    "global_pop_candidates": _with(BASE, gen_global_pop("likes", "target_users"),
                                   body="SELECT uid, item_id, score, 'global_pop' AS source FROM gp"),
    "cooccurrence_pairs": _with(BASE, _cooc("likes", "cv"), body="SELECT item_i, item_j, w FROM cv_g"),
    "covisitation_topk": _with(BASE, _cooc("likes", "cv"), _sparse("cv"), body="SELECT item_i, item_j, w FROM cv_s"),
    "covisitation_candidates": _with(BASE, gen_covisitation("likes", "target_users"),
                                     body="SELECT uid, item_id, score, 'covisitation' AS source FROM cv"),
    "retrieval_merge": _with(*merged_ctes(), body="SELECT * FROM cands"),
    "feat_item_static": _feature_sql(F_ITEM),
    "feat_user_static": _feature_sql(F_USER),
    "feat_item_trend": _feature_sql(F_TREND),
    "feat_user_artist": _feature_sql(F_UA),
    "feat_artist_static": _feature_sql(F_ART),
    "feat_source_count": _feature_sql(F_COUNT),
    "dataset_with_target": _with(*_dataset_cte(), body="SELECT * FROM ds"),
    "coverage_by_generator": _with(*_dataset_cte(), """tl AS (SELECT count(*) AS n FROM train
  WHERE uid IN (SELECT uid FROM ds))""", body="""SELECT (SELECT n FROM tl) AS true_likes, count(*) AS found_total,
  (SELECT n FROM tl) - count(*) AS lost_likes,
  round(CAST(count(*) AS DOUBLE) / (SELECT n FROM tl), 6) AS recall_total,
  round(coalesce(sum(is_global_pop), 0.0) / (SELECT n FROM tl), 6) AS recall_is_global_pop,
  round(coalesce(sum(is_artist_pop), 0.0) / (SELECT n FROM tl), 6) AS recall_is_artist_pop,
  round(coalesce(sum(is_covisitation), 0.0) / (SELECT n FROM tl), 6) AS recall_is_covisitation
  FROM ds WHERE target = 1"""),
    "coverage_by_flags": _with(*_dataset_cte(), """tl AS (SELECT count(*) AS n FROM train
  WHERE uid IN (SELECT uid FROM ds))""", body="""SELECT is_global_pop, is_artist_pop, is_covisitation,
  count(*) AS total_in_group, CAST(sum(target) AS BIGINT) AS likes_in_group,
  round(CAST(sum(target) AS DOUBLE) / count(*) * 100.0, 4) AS conversion_pct,
  round(CAST(sum(target) AS DOUBLE) / (SELECT n FROM tl) * 100.0, 2) AS contribution_pct
  FROM ds GROUP BY is_global_pop, is_artist_pop, is_covisitation"""),
    "target_counts": _with(*_dataset_cte(), body="SELECT target, count(*) AS n FROM ds GROUP BY target"),
    "recall_at_k": _with(*merged_ctes(), _TOP_CANDS.replace(str(SUBMISSION_K), str(RECALL_K)),
                         body="""SELECT count(*) AS hits, (SELECT count(*) FROM train) AS truth_rows,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM train), 6) AS recall
  FROM top t JOIN train r ON r.uid = t.uid AND r.item_id = t.item_id"""),
    "submission": _with(*merged_ctes(), _TOP_CANDS, body=_submission_body("train_users")),
    "vector_topk_join": f"""SELECT qid, item_id, round(score, 4) + 0.0 AS score FROM (
  SELECT qid, item_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, item_id) AS rn FROM (
    SELECT a.vec_id AS qid, b.vec_id AS item_id, {_vec_dot('a', 'b')} AS score
    FROM embeddings a CROSS JOIN embeddings b)) WHERE rn <= {VECTOR_K}""",
    "pair_dot_rank": _with(BASE, _POP_UNSEEN, f"""d AS (SELECT c.uid, c.item_id,
  coalesce({_vec_dot('ue', 'ie')}, 0.0) AS als_dot FROM cands c
  LEFT JOIN embeddings ue ON ue.vec_id = c.uid LEFT JOIN embeddings ie ON ie.vec_id = c.item_id)""",
                           body="""SELECT uid, item_id, round(als_dot, 4) + 0.0 AS als_dot,
  rank() OVER (PARTITION BY uid ORDER BY als_dot DESC) AS als_rank FROM d"""),
    "ease_gram": _with(BASE, f"""top AS (SELECT item_id FROM likes GROUP BY item_id ORDER BY count(*) DESC, item_id
  LIMIT {EASE_TOP_K_ITEMS}),
c AS (SELECT uid, item_id, count(*) AS n FROM likes WHERE item_id IN (SELECT item_id FROM top) GROUP BY 1, 2)""",
                       body=f"""SELECT a.item_id AS item_i, b.item_id AS item_j,
  CAST(sum(a.n * b.n) AS DOUBLE) + CASE WHEN a.item_id = b.item_id THEN {_d(EASE_L2)} ELSE {_d(0.0)} END AS g
  FROM c a JOIN c b ON a.uid = b.uid GROUP BY 1, 2"""),
    "ease_weight_residual": _with(BASE, body=f"""SELECT item_id AS item_j, true AS ok FROM (SELECT item_id FROM likes
  GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT {EASE_TOP_K_ITEMS})"""),
}

_MAPPING = "artist_mapping AS (SELECT p_partkey AS item_id, CAST(substr(p_brand, 7) AS BIGINT) AS artist_id FROM part)"
_MAPPING_MULTI = """artist_mapping AS (SELECT item_id, CASE WHEN item_id % 17 <> 0 THEN artist_id END AS artist_id FROM (
  SELECT p_partkey AS item_id, CAST(substr(p_brand, 7) AS BIGINT) AS artist_id FROM part
  UNION ALL SELECT p_partkey, 100 + p_size FROM part WHERE p_partkey % 10 = 0))"""
for _name in ("artist_top_tracks", "artist_pop_candidates"):
    SQL[f"{_name}_multi"] = SQL[_name].replace(_MAPPING, _MAPPING_MULTI)
SQL["split_temporal_long"] = SQL["split_temporal"].replace(_d(0.93), _d(0.75)).replace(_d(0.98), _d(0.90))
# every target user with history is ok; those without are in neither table
_EVERY_USER = _with(BASE, body="SELECT DISTINCT l.uid, true AS ok FROM likes l JOIN target_users t ON t.uid = l.uid")
SQL |= {name: _EVERY_USER for name in ("ease_scores_check", "ials_topk_check", "ials_i2i_check")}
SQL["ials_normal_equations"] = _with(BASE, body="SELECT DISTINCT uid, true AS ok FROM likes")
SQL["feat_ials_dot_check"] = _with(BASE, SPLIT, body="SELECT uid, true AS ok FROM train_users")
SQL["full_chain_check"] = _with(BASE, SPLIT, body="SELECT uid, true AS ok FROM train_users")
SQL["ranker_scores_check"] = _with(*merged_ctes(), body="SELECT uid, item_id, true AS ok FROM cands")
SQL["ranker_auc_check"] = "SELECT true AS ok"
SQL["auc_merge_scores"] = _with(*merged_ctes(), """counts AS (
  SELECT c.score AS s, count(t.uid) AS pos, count(*) - count(t.uid) AS neg
  FROM cands c LEFT JOIN (SELECT DISTINCT uid, item_id FROM train) t ON c.uid = t.uid AND c.item_id = t.item_id GROUP BY c.score),
below AS (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM counts)""",
    body="SELECT CAST(sum(pos * (2 * b + neg)) AS DOUBLE) / (2.0 * CAST(sum(pos) * sum(neg) AS DOUBLE)) AS auc FROM below")
