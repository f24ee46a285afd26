"""Structured Streaming forms of ingest (I1, I2), scoring (I3) and monitors (I4)."""
