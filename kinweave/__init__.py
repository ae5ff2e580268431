"""Record linkage on Spark: blocking keys, bounded postings, scored candidates and their evaluation."""
