"""Training-data operators: search, near-duplicates, sharding, mixing, scans,
classifiers, fingerprints and packing. Nothing outside this folder imports it."""
