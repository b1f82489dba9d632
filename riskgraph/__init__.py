"""riskgraph: lending-risk cohorts, risk lists and call graphs as Spark DataFrame operators."""

__version__ = "0.1.0"
