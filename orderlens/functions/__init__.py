"""Column expressions: timestamps, measures, bands and joined texts."""
