"""Readers, writers, registries and data generators."""
