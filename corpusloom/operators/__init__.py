"""DataFrame operators: record builders, selection, scoring, profiles."""
