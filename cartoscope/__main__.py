"""Command line: show what a command returns."""

import sys

from pyspark.sql import SparkSession

from .commands import main

if __name__ == "__main__":
    main(SparkSession.builder.appName("cartoscope").getOrCreate(), sys.argv[1:]).show(1000, truncate=False)
