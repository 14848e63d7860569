"""Jobs composed from the operators, and plan inspection helpers."""
