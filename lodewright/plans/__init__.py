"""Jobs made of several statements, and the registered queries with their SQL counterparts."""
