"""Event-ingestion engine on Spark: landed API pages in, one deduplicated event table out."""
