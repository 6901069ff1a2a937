"""Readers, importers and the partitioned table store."""
