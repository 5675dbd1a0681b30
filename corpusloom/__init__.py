"""corpusloom: operators on Spark DataFrames and streams for curated, addressed text corpora."""
