"""Row routing, keyed matching, change application, validation and batching."""
