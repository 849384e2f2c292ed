"""claimflow: insurance-claims cleaning, quality checks, star schema and
rule-based scoring expressed as ordinary Spark DataFrame jobs."""

__version__ = "0.1.0"
