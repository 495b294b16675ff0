"""Text-corpus and tabular analytics written as Spark DataFrame operators."""
