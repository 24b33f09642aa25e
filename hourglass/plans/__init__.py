"""Jobs, the query catalog and plan inspection helpers."""
