"""credscope: Spark-native loan-risk analytics."""
