"""Operators: cohorts, risk lists, call edges, neighbours, repayment facts."""
