"""Incremental staging of newly arrived filings."""
