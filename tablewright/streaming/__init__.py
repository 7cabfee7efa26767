"""Scoring a feed of rows with a stored model."""
