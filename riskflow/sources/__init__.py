"""Readers and writers: files, event streams, stored tables, and the driver's test tables."""
