"""Sources: drop files, source tables, staging, and the test views over the driver tables."""
