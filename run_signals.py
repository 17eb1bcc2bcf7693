"""Launcher: spark-submit run_signals.py RAW_PATH OUT_PATH."""

import sys

from murmuration.plans.pipeline import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
