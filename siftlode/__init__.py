"""siftlode: crawled-page analytics and corpus preparation as lazy Spark DataFrames."""
