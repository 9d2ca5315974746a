"""Whole jobs: operators composed over the tables of a source and a destination store."""
