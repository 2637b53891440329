"""Structured Streaming forms of the time-bucket aggregate and of the
incremental scaler: the same column logic as the batch functions, driven by
``readStream`` and finished with ``availableNow`` triggers."""
