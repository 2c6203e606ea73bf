"""Launcher for spark-submit: ``spark-submit --py-files histwright.zip run_day.py run-day ...``."""

from histwright.__main__ import main

if __name__ == "__main__":
    main()
