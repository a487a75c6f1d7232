"""Role views over the generated parquet tables, registered queries and their SQL."""
