"""Relational and numeric operators over DataFrames."""
