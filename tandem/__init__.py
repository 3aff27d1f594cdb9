"""tandem — two-stage recommendation analytics on Spark DataFrames.

Stage 1 generates candidates (popularity, artist popularity, co-visitation,
EASE, implicit ALS, item-to-item vector search), merges them and removes known
pairs; stage 2 joins features, attaches targets, trains a gradient-boosted
ranker and writes the top-k per user. Every step takes and returns DataFrames.
"""

__version__ = "0.1.0"
