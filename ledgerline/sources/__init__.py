"""Sources: CSV ingest to all-text bronze tables, projected scans, test binding."""
