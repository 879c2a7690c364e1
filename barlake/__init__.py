"""Market-bar lakehouse operators for Spark: every operator is DataFrame -> DataFrame."""
