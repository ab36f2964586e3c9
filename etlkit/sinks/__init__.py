"""File, table and JDBC sinks with a chosen layout."""
