"""Snapshots, stage tables and result files."""
