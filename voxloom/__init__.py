"""voxloom: building and evaluating speech-text corpora with Spark DataFrames."""
