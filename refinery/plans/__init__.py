"""Jobs and query catalog: silver cleaning, gold star schema, quality report,
layer order, and the registered queries with their SQL statements."""
