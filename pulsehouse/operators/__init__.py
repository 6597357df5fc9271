"""Row-level and keyed operators: enrichment, detectors, sessions."""
