"""Analytics over camera frames that carry object detections, on Spark DataFrames and streams."""
