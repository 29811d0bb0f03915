"""Whole stages put together from operators; each is one lazy plan."""
