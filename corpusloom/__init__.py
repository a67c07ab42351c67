"""corpusloom: Spark-native building, auditing and export of labelled text corpora."""
