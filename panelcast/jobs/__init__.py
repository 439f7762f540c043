"""The batch jobs: prepare, predict, report, refresh venues."""
