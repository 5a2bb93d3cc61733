"""Where rows come from and go to: query templates, JDBC, versioned Parquet."""
