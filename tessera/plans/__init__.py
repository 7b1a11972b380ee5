"""Whole plans: stages, rounds and the catalogue of queries."""
