"""Row operators: chunked ordered scans, segments, trip roll-ups."""
