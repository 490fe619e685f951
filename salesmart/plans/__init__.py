"""Registered queries (``queries``), their SQL oracles, and the whole-job plan."""
