"""Report shaping and end-to-end jobs."""
