"""Panel projection on Spark: partial transaction panels -> full-universe market tables."""
