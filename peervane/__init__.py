"""Peer-relative scoring of daily price panels, written as Spark DataFrame plans."""
