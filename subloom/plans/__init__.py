"""Query catalogue, pipeline, reports and command line."""
