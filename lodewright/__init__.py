"""Data jobs over dimension tables, SQL-script corpora and change streams, on Spark."""
