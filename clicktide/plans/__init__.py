"""The four jobs: each has ``build`` (event frames -> sink rows), ``start`` and a spark-submit entry."""
