"""Raw feeds, API payloads and stored pages as DataFrames."""
