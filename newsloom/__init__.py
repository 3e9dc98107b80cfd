"""newsloom: a Spark-native engine for archives of periodical mail."""
