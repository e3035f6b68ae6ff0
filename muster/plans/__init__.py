"""KPI plans, gold tables, served projections and the refresh job."""
