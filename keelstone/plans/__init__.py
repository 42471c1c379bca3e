"""Star schema, batch run and analytic queries."""
