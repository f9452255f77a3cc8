"""adloom: a Spark-native engine for job-ad corpora."""
