"""Load mobile-app store report files into date-partitioned tables with Spark."""
