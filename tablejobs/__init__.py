"""Table jobs on Spark: loading, joining, nesting, counting, ranking, quartile classes, features and models over DataFrames."""
