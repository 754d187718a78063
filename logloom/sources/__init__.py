"""Sources (S-01..S-09) and sinks (K-01..K-07)."""
