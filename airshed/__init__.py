"""airshed: Spark-native environmental analytics jobs."""
