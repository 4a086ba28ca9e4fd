"""Plans: the pipeline composition, the SQL-view route and registered queries."""
