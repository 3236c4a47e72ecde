"""The registered queries on the driver's tables, with their SQL counterparts."""
