"""Sources: landed JSON payloads, their flattening into staging rows, and table roles."""
