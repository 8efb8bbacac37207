"""Retail point-of-sale feeds to a star schema, as Spark jobs."""
