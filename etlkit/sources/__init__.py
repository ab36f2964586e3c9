"""Table, file, JDBC and synthetic sources."""
