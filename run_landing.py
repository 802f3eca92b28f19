"""Entry script for spark-submit."""

from wayfleet.streaming.job import main

if __name__ == "__main__":
    main()
