"""Readers for position streams, raw feeds, route geometry and logs."""
