"""Readers: driver tables and stand-ins, landed CSV families, JSON snapshots."""
