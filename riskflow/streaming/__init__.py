"""The structured-streaming job, its dead letters and its monitoring."""
