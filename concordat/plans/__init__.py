"""SQL dialects read as Spark SQL, and the catalogue of queries."""
