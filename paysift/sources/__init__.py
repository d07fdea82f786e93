"""Readers, dated snapshots and writers."""
