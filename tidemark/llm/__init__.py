"""Training-data operators: language-model scoring, similarity joins, filters, scans, tokenising, packing,
deduplication, sharding and HTML extraction. Nothing else in the library imports this subpackage."""
