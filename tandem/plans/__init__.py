"""Generators, feature sources, dataset, ranker, evaluation, submission and the registered queries."""
