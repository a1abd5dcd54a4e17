"""DataFrame operators that Spark does not ship ready made."""
