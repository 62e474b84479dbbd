"""CDC tables to trusted order and store marts, as PySpark DataFrame operators and batch jobs."""
