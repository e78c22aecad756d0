"""Readers: driver tables, the movement / stock extracts and the log / run fixtures."""
