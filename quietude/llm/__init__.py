"""Training-data operators: tokenising, deduplication, filtering, search and
mixing of text corpora. Nothing outside this subpackage imports it."""
