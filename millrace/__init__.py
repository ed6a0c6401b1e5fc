"""millrace: feed curation, ranking and periodic-statistics analytics on PySpark DataFrames."""
