"""Evidence-first record intelligence on Spark."""
