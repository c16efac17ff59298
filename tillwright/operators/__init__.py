"""Table-level operators: profile, cleanse, conform, enrich, model, aggregate, segment, reconcile."""
