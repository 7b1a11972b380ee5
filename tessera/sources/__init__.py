"""Readers, writers, configuration and model providers."""
