"""DataFrame operators: parse, clean, statistics, joins, features, models."""
