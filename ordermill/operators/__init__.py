"""Dataset operators: classification, lookups, reports, run accounting, sampling."""
