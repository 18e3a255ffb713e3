"""Job queries over the star-schema test tables, each beside its equivalent ANSI SQL."""
