"""bayline: service-operations analytics written as Spark DataFrame functions."""
