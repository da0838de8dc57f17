"""Readers and writers of the layers (bronze snapshots, silver, gold, run
metrics) and the logical-name registry of raw sources."""
