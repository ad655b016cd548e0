"""A Spark-native engine for enriching and analysing collections of sequence intervals."""
