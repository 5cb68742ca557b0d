"""Streaming forms of ingest and detection. They reuse the batch operators and go beyond the batch scope."""
