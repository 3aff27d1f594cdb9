"""Candidate generators (C1-C6) and the retrieval merge.

Protocol, like ``ml.Estimator``/``Model``: ``fit(history)`` builds the fitted
tables (lazily, or through a ``FittedStore`` so a later run reuses them), and
``generate(users, history, num_candidates)`` returns
``(uid, item_id, score, source)``. Everything stays a lazy DataFrame; there is
no user batch loop — Spark partitions do that job.
"""

from __future__ import annotations

import math
from abc import ABC, abstractmethod
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem import schemas
from tandem.operators import als as als_ops
from tandem.operators import ease as ease_ops
from tandem.operators.interactions import artist_item_counts, item_counts, user_artist_counts
from tandem.operators.joins import attach_list, bounded_broadcast
from tandem.operators.similarity import cooccurrence, covisitation_scores, in_passes, neighbour_lists, sparsify
from tandem.operators.topk import (average_rank_filter, dedupe_max, global_index, global_top_n,
                                   recent_per_user, top_score_per_user)
from tandem.operators.vectors import topk_inner_product
from tandem.sources.io import FittedStore, delete_table, materialise, read_table, write_scratch, write_table


def _tag(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col("uid").cast("long"), F.col("item_id").cast("long"),
                     F.col("score").cast("double"), F.lit(name).alias("source"))


class CandidateGenerator(ABC):
    name: str = "generator"

    def __init__(self, store: FittedStore | None = None):
        self.store = store

    def _fitted(self, table: str, build, force: bool, history: DataFrame) -> DataFrame:
        if self.store is None:
            # fitted tables are reused by every user: materialise them once in
            # the shared checkpoint folder (lineage cut, cheap size probes)
            return materialise(build())
        return self.store.fit_or_load(self.name, table, build, force, self.store.describe(self, history))

    @abstractmethod
    def fit(self, history: DataFrame, force: bool = False) -> "CandidateGenerator": ...

    @abstractmethod
    def generate(self, users: DataFrame, history: DataFrame, num_candidates: int) -> DataFrame: ...


class GlobalPopularity(CandidateGenerator):
    """The ``top_n`` most liked items for every user (``num_candidates``
    is ignored; ``top_n`` bounds the output)."""
    name = "global_pop"

    def __init__(self, top_n: int = 100, store: FittedStore | None = None):
        super().__init__(store)
        self.top_n = top_n
        self.top_items = None

    def fit(self, history, force=False):
        self.top_items = self._fitted("top_items", lambda: (
            global_top_n(item_counts(history), [F.desc("n"), F.asc("item_id")], self.top_n)
            .select("item_id", F.col("n").cast("double").alias("score"))), force, history)
        return self

    def generate(self, users, history, num_candidates):
        return _tag(attach_list(users.select("uid"), self.top_items, ["item_id", "score"]), self.name)


class ArtistPopularity(CandidateGenerator):
    """C4: for each user's ``top_n_artists`` artists (average rank of the
    user's like count), the artist's ``tracks_per_artist`` top tracks
    (average rank of the track's like count); score = track like count."""
    name = "artist_pop"

    def __init__(self, artist_mapping: DataFrame, top_n_artists: int = 10, tracks_per_artist: int = 10,
                 store: FittedStore | None = None, broadcast_rows: int = 2_000_000):
        super().__init__(store)
        self.mapping = artist_mapping
        self.top_n_artists = top_n_artists
        self.tracks_per_artist = tracks_per_artist
        self.broadcast_rows = broadcast_rows
        self.top_tracks = None

    def fit(self, history, force=False):
        self.top_tracks = self._fitted("artist_top_tracks", lambda: (
            average_rank_filter(artist_item_counts(history, self.mapping), "artist_id", "n",
                                self.tracks_per_artist)
            .select("artist_id", "item_id", F.col("n").cast("double").alias("artist_score"))), force, history)
        return self

    def favourite_artists(self, users, history):
        h = history.join(users, "uid", "left_semi")
        return average_rank_filter(user_artist_counts(h, self.mapping), "uid", "n", self.top_n_artists)

    def generate(self, users, history, num_candidates):
        fav = self.favourite_artists(users, history).select("uid", "artist_id")
        # few artists can carry most users: never shuffle-join on artist_id
        # when the top-track table is small enough to ship (size checked)
        top = bounded_broadcast(self.top_tracks, self.broadcast_rows)
        out = fav.join(top, "artist_id").select("uid", "item_id", F.col("artist_score").alias("score"))
        return _tag(out, self.name)


class CoVisitation(CandidateGenerator):
    """Item-item co-occurrence, top ``top_k_similar`` per item; users
    are scored from their ``history_depth`` newest likes."""
    name = "covisitation"

    def __init__(self, top_k_similar: int = 100, history_depth: int = 30,
                 store: FittedStore | None = None):
        super().__init__(store)
        self.top_k = top_k_similar
        self.history_depth = history_depth
        self.similarity = self._near = None

    def fit(self, history, force=False):
        self._near = None
        self.similarity = self._fitted("similarity", lambda: sparsify(cooccurrence(history, most=self.top_k), self.top_k), force, history)
        return self

    def generate(self, users, history, num_candidates):
        if self._near is None:
            self._near = neighbour_lists(self.similarity)
        return _tag(covisitation_scores(history, self.similarity, users, self.history_depth,
                                        num_candidates, self._near), self.name)


class Ease(CandidateGenerator):
    """EASE over the ``top_k_items`` most liked items."""
    name = "ease"

    def __init__(self, top_k_items: int = 60000, l2_reg: float = 500.0, store: FittedStore | None = None,
                 tile: int = ease_ops.TILE):
        super().__init__(store)
        self.top_k_items = top_k_items
        self.l2_reg = l2_reg
        self.tile = tile
        self.model: ease_ops.EaseModel | None = None

    def fit(self, history, force=False):
        if self.store is None:
            self.model = ease_ops.fit(history, self.top_k_items, self.l2_reg, self.tile)
            return self
        path, fitted_with = self.store.path(self.name, "model"), self.store.describe(self, history)
        if not force and self.store.usable(self.name, "model", "weights", fitted_with):
            self.model = ease_ops.load(history.sparkSession, path)
        else:
            self.model = ease_ops.fit(history, self.top_k_items, self.l2_reg, self.tile, path)
            self.store.record(self.name, "model", fitted_with)
        return self

    def generate(self, users, history, num_candidates):
        return _tag(ease_ops.score(self.model, history, users, num_candidates), self.name)


class IALS(CandidateGenerator):
    """Implicit ALS (``operators/als.py``), user -> item top-K by inner product.

    Confidence: the reference weighs each like by ``alpha`` (repeats add), i.e.
    confidence ``alpha * n``; a rating is what that exceeds 1 by. As in Spark ML, whose first
    factors are taken, the regularisation is scaled by each row's rating count, so
    ``regularization`` is exposed but not equal in effect to the reference's.
    """
    name = "ials"

    def __init__(self, factors: int = 128, iterations: int = 30, alpha: float = 40.0,
                 regularization: float = 0.1, seed: int = 42, store: FittedStore | None = None,
                 checkpoint_interval: int = 10):
        super().__init__(store)
        if alpha <= 1:
            raise ValueError("alpha must be above 1: a single like has confidence alpha, and 1 means no like")
        self.factors, self.iterations = factors, iterations
        self.alpha, self.regularization, self.seed = alpha, regularization, seed
        self.checkpoint_interval = checkpoint_interval  # of the first factors' plan; every half-step is written anyway
        self.user_factors = self.item_factors = None
        self.user_codes = self.item_codes = None
        self.encoded = False

    def fit(self, history, force=False):
        from tandem.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(history.sparkSession)
        counts = history.groupBy("uid", "item_id").agg(F.count(F.lit(1)).alias("n"))
        b = history.agg(F.min("uid").alias("u0"), F.max("uid").alias("u1"),
                        F.min("item_id").alias("i0"), F.max("item_id").alias("i1")).first()
        lo, hi = -(2**31), 2**31 - 1
        # ALS wants int32 ids: larger ids get dense codes from a distributed
        # global index (W5); otherwise ids are used as they are
        self.encoded = b["u0"] is not None and not (lo <= b["u0"] and b["u1"] <= hi and
                                                    lo <= b["i0"] and b["i1"] <= hi)
        if self.encoded:
            self.user_codes = self._fitted("user_codes", lambda: global_index(
                history.select("uid").distinct(), ["uid"], "code"), force, history)
            self.item_codes = self._fitted("item_codes", lambda: global_index(
                history.select("item_id").distinct(), ["item_id"], "code"), force, history)
            coded = (counts.join(self.user_codes.withColumnRenamed("code", "user"), "uid")
                     .join(self.item_codes.withColumnRenamed("code", "item"), "item_id"))
        else:
            coded = counts.withColumn("user", F.col("uid")).withColumn("item", F.col("item_id"))
        ratings = coded.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"),
                               (F.lit(self.alpha) * F.col("n") - 1.0).cast("float").alias("rating"))
        users, items = self._model(history, ratings, force)
        self.user_factors = self._decode(users, "uid")
        self.item_factors = self._decode(items, "item_id")
        return self

    def _model(self, history, ratings, force):
        """(id, features) of users and items, by code where ids are encoded; kept in the store."""
        if self.store is None:
            return self._fit_model(ratings)
        spark, path = history.sparkSession, self.store.path(self.name, "model")
        fitted_with = self.store.describe(self, history)
        if force or not self.store.usable(self.name, "model", "items", fitted_with):
            delete_table(spark, path)
            for table, df in zip(("users", "items"), self._fit_model(ratings), strict=True):
                write_table(df, f"{path}/{table}")
            self.store.record(self.name, "model", fitted_with)
        return read_table(spark, f"{path}/users"), read_table(spark, f"{path}/items")

    def _fit_model(self, ratings):
        from pyspark.ml.recommendation import ALS

        ratings, path = write_scratch(ratings)
        first = ALS(rank=self.factors, maxIter=0, regParam=self.regularization, alpha=1.0, implicitPrefs=True,
                    seed=self.seed, userCol="user", itemCol="item", ratingCol="rating",
                    checkpointInterval=self.checkpoint_interval).fit(ratings)
        if self.iterations == 0:
            fitted = tuple(materialise(f.select(F.col("id").cast("long"), "features")) for f in (first.userFactors, first.itemFactors))
        else:
            fitted = als_ops.fit(ratings, first.userFactors, self.factors, self.iterations, self.regularization)
        delete_table(ratings.sparkSession, path)
        return fitted

    def _decode(self, factors, key):
        """(code, features) -> (real id, features)."""
        if not self.encoded:
            return factors
        codes = self.user_codes if key == "uid" else self.item_codes
        return (factors.join(codes.select(F.col("code").cast("long").alias("id"), F.col(key).alias("_real")), "id")
                .select(F.col("_real").cast("long").alias("id"), "features"))

    def generate(self, users, history, num_candidates):
        u = users.select("uid")
        known = self.user_factors.join(u.select(F.col("uid").alias("id")), "id", "left_semi")
        best = topk_inner_product(known, self.item_factors, num_candidates)
        return _tag(best.join(u, F.col("qid") == F.col("uid")), self.name)


class IALSItemToItem(CandidateGenerator):
    """Neighbours (by inner product of the C1 item factors) of each
    user's ``n_last_items`` newest known likes; ``n_similar_per_item`` each
    (the item itself included), deduplicated by max score, top
    ``num_candidates`` per user. Neighbours are searched once per distinct
    history item, not once per history row."""
    name = "ials_i2i"

    def __init__(self, ials: IALS, n_last_items: int = 15, n_similar_per_item: int = 30):
        super().__init__(None)
        self.ials = ials
        self.n_last_items = n_last_items
        self.n_similar_per_item = n_similar_per_item

    def fit(self, history, force=False):
        return self  # reuses the C1 factors

    def generate(self, users, history, num_candidates):
        item_f = self.ials.item_factors
        # the newest likes first, then what the model knows of them: an unknown
        # like is not replaced by an older one
        h = history.join(users, "uid", "left_semi")
        recent = (recent_per_user(h, self.n_last_items).select("uid", F.col("item_id").alias("src"))
                  .join(item_f.select(F.col("id").alias("src")), "src", "left_semi"))
        sources = recent.select(F.col("src").alias("id")).distinct().join(item_f, "id")
        nn = topk_inner_product(sources, item_f, self.n_similar_per_item)
        cand = recent.join(nn.withColumnRenamed("qid", "src"), "src").select("uid", "item_id", "score")
        best = dedupe_max(cand, ["uid", "item_id"])
        return _tag(top_score_per_user(best, num_candidates), self.name)


class RetrievalStage:
    """Tag each generator's rows, union, keep max score and 0/1 flags per
    ``(uid, item_id)``, drop pairs already in the history. Users come in shares of about ``pass_rows`` rows to merge."""

    def __init__(self, generators: Sequence[CandidateGenerator], pass_rows: int = 400_000_000):
        self.generators = list(generators)
        self.pass_rows = pass_rows

    def fit_all(self, history: DataFrame, force: bool = False) -> "RetrievalStage":
        for g in self.generators:
            g.fit(history, force)
        return self

    def fetch_all(self, users: DataFrame, history: DataFrame, num_candidates_per_gen: int = 200) -> DataFrame:
        rows = users.count() * num_candidates_per_gen * len(self.generators)
        return in_passes(users, math.ceil(rows / self.pass_rows), lambda some: self._merged(some, history, num_candidates_per_gen))

    def _merged(self, users: DataFrame, history: DataFrame, num_candidates_per_gen: int) -> DataFrame:
        parts = [g.generate(users, history, num_candidates_per_gen)
                 .select("uid", "item_id", "score", F.lit(1.0).alias(f"is_{g.name}"))
                 for g in self.generators]
        if not parts:
            return users.sparkSession.createDataFrame([], schemas.SCORED)
        combined = parts[0]
        for p in parts[1:]:
            combined = combined.unionByName(p, allowMissingColumns=True)
        merged = combined.groupBy("uid", "item_id").agg(
            F.max("score").alias("score"),
            *[F.coalesce(F.max(f"is_{g.name}"), F.lit(0.0)).alias(f"is_{g.name}") for g in self.generators])
        seen = history.select("uid", "item_id")
        return merged.join(seen, ["uid", "item_id"], "left_anti")
