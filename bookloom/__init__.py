"""Marketing-bookings analytics on Spark: webhooks and ad spend in, reporting tables and report frames out."""
