"""Named queries over the tables, each with SQL that says the same for a second engine."""
