"""Analytics marts as Spark jobs: staging, dimensions, vaults, marts and streams."""
