"""The three entries: raw tables to clean tables, clean tables to wide trips, wide trips to scores."""
