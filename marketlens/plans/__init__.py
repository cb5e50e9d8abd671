"""Silver, gold and warehouse pipelines, and the registered queries."""
