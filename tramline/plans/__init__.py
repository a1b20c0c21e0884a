"""Whole jobs: bus day, rail events and trips, alerts, schedule archive, extracts.

A job chains several ordered scans. Each scan reads its input twice, so jobs
write the stages between them to the shared folder (``cut_lineage``).
"""
