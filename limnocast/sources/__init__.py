"""Readers and writers of forecast, target, score and driver tables."""
