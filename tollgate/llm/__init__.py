"""Training-data operators: dedup, classifiers, scans, mixing and output."""
