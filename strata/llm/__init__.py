"""Training-data operators: quality, privacy, de-duplication, search, mixing,
sharding and packing of a document corpus. Nothing outside this subpackage
imports it."""
