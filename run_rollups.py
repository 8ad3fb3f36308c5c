"""Entry script for ``spark-submit``; see :mod:`spintally.job`."""

from spintally.job import main

if __name__ == "__main__":
    main()
