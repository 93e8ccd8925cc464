"""Plans: registered queries, their DuckDB oracle twins, and the catalog."""
