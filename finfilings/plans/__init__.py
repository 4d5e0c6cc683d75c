"""Ready-made pipelines over a landing folder."""
