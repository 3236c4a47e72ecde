"""Where entity tables are read from and committed to."""
