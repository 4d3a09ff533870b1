"""spark-submit launcher for ``assurspark.cli`` (ship the package with --py-files)."""
import sys

from assurspark.cli import main

if __name__ == "__main__":
    main(sys.argv[1:])
