"""Launcher for spark-submit; see riskstream/jobs.py for the commands."""

from riskstream.jobs import main

main()
