"""DataFrame → DataFrame operators: catalog, routing, schema, projection and status."""
