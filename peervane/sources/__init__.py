"""Readers of raw filings, staged tables, and writers of results."""
