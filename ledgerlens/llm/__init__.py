"""Training-data operators: tokenising, packing, cleaning, deduplicating and
sharding a document corpus.  Nothing outside this subpackage imports it."""
