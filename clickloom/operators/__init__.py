"""DataFrame operators: cleaning, counting, sessions, features, models, segments, lookups."""
