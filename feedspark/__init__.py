"""feedspark: Spark jobs over feeds that publish complete snapshots again and again."""
