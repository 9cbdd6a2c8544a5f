"""Readers for report files, snapshots and stored tables."""
