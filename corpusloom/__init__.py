"""corpusloom: a PySpark-native engine for building, deduplicating, splitting,
auditing and describing provenance-tracked annotation and text corpora."""
