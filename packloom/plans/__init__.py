"""End-to-end plans: the query catalog over the tables, and the ingestion of packs and dictionaries."""
