"""korvane: record linkage and corpus operators as Spark DataFrame plans."""
