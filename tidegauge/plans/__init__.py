"""Plan fragments shared by operators: running aggregates and watermarks."""
