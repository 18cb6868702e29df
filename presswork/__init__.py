"""News sentiment analytics as Spark DataFrame jobs: feed -> queue -> articles -> labels."""
