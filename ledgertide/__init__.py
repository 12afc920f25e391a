"""Multi-market regulatory reporting for betting and gaming data, as Spark jobs."""
