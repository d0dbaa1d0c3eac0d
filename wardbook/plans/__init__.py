"""The 28 jobs and the warehouse that wires them."""

from wardbook.plans.warehouse import JOBS, Job, Warehouse

__all__ = ["JOBS", "Job", "Warehouse"]
