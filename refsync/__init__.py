"""Reference-data synchronization as Spark DataFrame operators."""
