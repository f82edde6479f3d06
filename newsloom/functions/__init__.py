"""Column builders: parsing, text and sentiment. None of them starts a Spark job."""
