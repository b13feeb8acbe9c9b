"""Speech-dataset preparation and Hebrew text normalization on Spark."""
