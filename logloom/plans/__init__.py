"""Query plans: fixtures derived from the driver tables and the named
queries registered in ``__spark_entry__``."""
