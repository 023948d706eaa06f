"""DataFrame operators: deduplication, resolution, sampling, profiling, features, metrics."""
