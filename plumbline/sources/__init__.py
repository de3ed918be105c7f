"""Sources: files and APIs fetched on the driver and preserved, and scans of them by Spark."""
