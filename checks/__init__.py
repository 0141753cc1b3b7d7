"""The registry behind ``__spark_entry__``: Spark queries and the SQL they must equal."""
