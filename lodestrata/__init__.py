"""A Spark-native engine for catalogs whose schema is data: diff, ETL, search, graph expansion and incremental runs."""
