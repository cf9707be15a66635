"""Lazy DataFrame -> DataFrame operators. None of them triggers a job."""
