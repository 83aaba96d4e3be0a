"""Where records come from: topics, files, and the record streams derived from the given tables."""
