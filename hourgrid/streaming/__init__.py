"""No streaming operators: the workload is bounded daily batches.

Late data is handled by re-running a day; the panel writer replaces exactly the
days a run produced (see ``hourgrid.sources.writers.write_panel``).
"""
