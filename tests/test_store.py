"""Fitted tables by name, and with a manifest of what they were fitted with."""

from pyspark.sql import functions as F

from tandem.plans.features import ItemStatic, ItemTrend
from tandem.plans.retrieval import IALS, ArtistPopularity, Ease, GlobalPopularity
from tandem.sources.io import FittedStore, fingerprint


def test_fingerprint_is_of_the_rows(spark, likes):
    assert fingerprint(likes) == fingerprint(likes.repartition(5).orderBy("timestamp"))
    assert fingerprint(likes) != fingerprint(likes.withColumn("is_organic", 1 - F.col("is_organic")))
    assert fingerprint(likes) != fingerprint(likes.unionByName(likes.limit(1)))
    assert fingerprint(likes.limit(0)) == fingerprint(likes.where("uid < 0"))


def test_other_parameters_or_data_fit_anew(spark, likes, mapping, tmp_path):
    store = FittedStore(spark, str(tmp_path), prefix="p", check=True)
    calls = []
    fit_or_load = store.fit_or_load
    store.fit_or_load = lambda component, table, build, force=False, fitted_with=None: fit_or_load(
        component, table, lambda: calls.append(component) or build(), force, fitted_with)
    more = likes.unionByName(likes.withColumn("uid", F.col("uid") + 50))
    n = lambda k, rows: GlobalPopularity(k, store=store).fit(rows).top_items.count()
    assert n(2, likes) == 2 and len(calls) == 1
    assert n(2, likes) == 2 and len(calls) == 1          # reused
    assert n(3, likes) == 3 and len(calls) == 2          # other parameter
    assert n(3, more) == 3 and len(calls) == 3           # other data
    assert n(3, more) == 3 and len(calls) == 3
    other = mapping.withColumn("artist_id", F.col("artist_id") + 1)
    for m, want in ((mapping, 1), (mapping, 1), (other, 2)):  # the mapping counts as data
        ArtistPopularity(m, store=store).fit(likes)
        ItemStatic(m, store=store).fit(likes)
        assert calls.count("artist_pop") == calls.count("item_static") == want
    ItemTrend(14, store=store).fit(likes)
    ItemTrend(7, store=store).fit(likes)
    assert calls.count("item_trend") == 2


def test_models_are_checked_too(spark, likes, tmp_path):
    store = FittedStore(spark, str(tmp_path), check=True)
    sizes = [Ease(k, 1.0, store=store).fit(likes).model.n_items for k in (2, 2, 3)]
    assert sizes == [2, 2, 3]
    def size(factors, store):
        return IALS(factors=factors, iterations=1, store=store).fit(likes).user_factors.select(F.size("features")).first()[0]

    assert [size(k, store) for k in (2, 2, 3)] == [2, 2, 3]
    # by name alone, whatever is there is reused
    assert size(5, FittedStore(spark, str(tmp_path))) == 3
