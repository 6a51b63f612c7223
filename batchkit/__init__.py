"""batchkit: batch analytics as plain DataFrame -> DataFrame functions."""
