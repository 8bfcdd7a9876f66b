"""DataFrame operators: paging, windows, shaping, change detection, state."""
