"""Python data sources, the landed page log and the state store."""
