"""Trip analytics as Spark jobs: landing, staging, facts, reports and data checks."""
