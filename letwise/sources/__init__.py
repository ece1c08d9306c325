"""Readers and writers: landed pages, raw CSV, lookup tables, versioned snapshots."""
