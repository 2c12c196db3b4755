"""DataFrame -> DataFrame steps: cleaning, profiling, dimensions, fact, checks."""
