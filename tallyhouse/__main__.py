"""``python -m tallyhouse <source> <out> [--master ...]`` runs the refresh job."""

from tallyhouse.plans.job import main

main()
