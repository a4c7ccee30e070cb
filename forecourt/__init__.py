"""Dealership analytics on Spark: landing, typed views, merges, rollups, matching, price models."""
