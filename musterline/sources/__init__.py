"""Readers: CSV with a file ledger, NDJSON, file and table streams, exchange messages."""
