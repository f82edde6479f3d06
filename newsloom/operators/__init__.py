"""DataFrame-to-DataFrame operators: dedup, merges, resampling, validation, profiling."""
