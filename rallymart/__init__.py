"""Match-analytics lakehouse: landed JSON to typed tables to a star schema, all as Spark jobs."""
