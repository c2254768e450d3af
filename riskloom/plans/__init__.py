"""Named queries assembled from the operators: mart, tiles, trends, metrics, models."""
