"""Structured Streaming forms of scoring, monthly means and trailing features."""
