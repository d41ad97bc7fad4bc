"""Decision analytics on Spark DataFrames: canonicalise, resolve, derive as of, judge, select, emit once, prove."""
