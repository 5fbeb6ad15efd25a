"""Silver, Gold, quality, dashboard, question and model jobs."""
