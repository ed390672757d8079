"""Project-portfolio analytics on Spark: landed JSON to star schema, measures, reports and audits."""
