"""Plans: the warehouse store, audit log, load jobs and the catalog of checked queries."""
