"""Sources: the driver's tables, derived fixtures, landed JSON pages and files."""
