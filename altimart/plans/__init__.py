"""The airline application: staging models, marts, decisions, KPIs, graph and query tools."""
