"""Reading landed data and writing versioned, keyed and append-only tables."""
