"""Tables, views, batch appends and NDJSON files."""
