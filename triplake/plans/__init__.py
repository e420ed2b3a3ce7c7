"""Multi-step jobs built from the operators: cleaning, staging writes, mart rebuild and increments."""
