"""Point-in-time analytics on Spark: bitemporal filters, as-of joins, forecasts and audits."""
