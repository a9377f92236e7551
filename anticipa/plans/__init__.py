"""The dashboard jobs: what each reads, computes and refreshes."""

from .jobs import DASHBOARDS, JOBS, Job, compute, refresh, refresh_all, rejects

__all__ = ["DASHBOARDS", "JOBS", "Job", "compute", "refresh", "refresh_all", "rejects"]
