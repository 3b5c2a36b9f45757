"""Table reads and writes: declared schemas, gold tables, versioned tables."""
