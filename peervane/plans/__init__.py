"""Whole rankings and replays, assembled from the operators."""
