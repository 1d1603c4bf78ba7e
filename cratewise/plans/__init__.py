"""Whole jobs: the full build and the dump sampler."""
