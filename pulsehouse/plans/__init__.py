"""Aggregation plans (the metric catalogue) and the named queries."""
