"""The same results in SQL, for checking the Spark jobs against another engine."""
