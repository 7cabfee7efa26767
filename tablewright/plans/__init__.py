"""Whole jobs: the two tracks, the query catalogue and the test fixtures."""
