"""Scalar Catalyst expressions."""
