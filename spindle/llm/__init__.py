"""Training-data operators: deduplication, decontamination, scoring, extraction,
filtering and mixing. Nothing outside this subpackage imports it."""
