"""End-to-end jobs, test-table binding, registered queries and their DuckDB oracle."""
